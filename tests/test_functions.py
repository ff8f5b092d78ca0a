"""Scalar functions on hand rows covering the reference's quirks."""

from pyspark.sql import functions as F

from civicflow.functions import (age_bucket, blank_to_null, day_diff, hour_diff, is_open, is_resolved,
                                 placeholder_to_null, surrogate_key, title_case, within)


def _one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_title_case_punctuation_is_a_word_break(spark):
    rows = [("HEAT/HOT WATER",), ("noise - street/sidewalk",), ("o'brien (n/a)",), (None,), ("",),
            ("a\tb",), ("  spaced  out ",), ("PAINT/PLASTER",), ("x",)]
    got = _one(spark, title_case("s"), rows, "s string")
    assert got == ["Heat/Hot Water", "Noise - Street/Sidewalk", "O'brien (N/A)", None, "", "A\tB",
                   "  Spaced  Out ", "Paint/Plaster", "X"]


def test_blank_and_placeholders(spark):
    got = _one(spark, blank_to_null("s"), [("  ",), (" a ",), (None,)], "s string")
    assert got == [None, "a", None]
    got = _one(spark, placeholder_to_null("s"), [(" n/a ",), ("Unspecified",), ("",), ("NA",), ("queens ",),
                                                  ("STATEN ISLAND",)], "s string")
    assert got == [None, None, None, None, "Queens", "Staten Island"]


def test_coordinate_bounds_reproduce_reference_and_can_be_corrected(spark):
    rows = [(40.5,), (-73.9,), (41.0,), (None,)]
    assert _one(spark, within("x", (40, 41)), rows, "x double") == [40.5, None, 41.0, None]
    assert _one(spark, within("x", (-75, -73)), rows, "x double") == [None, -73.9, None, None]


def test_hour_and_day_differences_count_boundaries(spark):
    df = spark.createDataFrame([("2024-01-01 10:59:00", "2024-01-01 11:01:00"),
                                ("2024-01-01 23:59:59", "2024-01-02 00:00:01"),
                                ("2024-01-01 00:00:00", "2024-01-01 00:59:59")], "a string, b string") \
        .select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    got = [tuple(r) for r in df.select(hour_diff("a", "b"), day_diff("a", "b")).collect()]
    assert got == [(1, 0), (1, 1), (0, 0)]


def test_age_bucket_edges(spark):
    got = _one(spark, age_bucket("d"), [(0,), (1,), (7,), (8,), (30,), (31,), (90,), (91,), (-3,)], "d int")
    assert got == ["Same Day", "Same Week", "Same Week", "Within Month", "Within Month", "Within Quarter",
                   "Within Quarter", "Over Quarter", "Same Week"]


def test_flags_can_both_be_false_and_never_null(spark):
    rows = [("Unspecified", "2024-01-02 00:00:00"), ("Closed", None), ("Closed", "2024-01-02 00:00:00"),
            (None, None), ("Open", "2024-01-02 00:00:00")]
    df = spark.createDataFrame(rows, "s string, c string").withColumn("c", F.col("c").cast("timestamp_ntz"))
    got = [tuple(r) for r in df.select(is_resolved("s", "c"), is_open("s", "c")).collect()]
    assert got == [(False, False), (False, True), (True, False), (False, True), (False, True)]


def test_surrogate_key_matches_md5_with_null_token(spark):
    import hashlib
    df = spark.createDataFrame([("Manhattan", 1), (None, 2)], "a string, b int")
    got = [r[0] for r in df.select(surrogate_key("a")).collect()]
    assert got[0] == hashlib.md5(b"Manhattan").hexdigest()
    assert got[1] == hashlib.md5(b"_dbt_utils_surrogate_key_null_").hexdigest()
    two = df.select(surrogate_key("a", "b")).collect()[1][0]
    assert two == hashlib.md5(b"_dbt_utils_surrogate_key_null_-2").hexdigest()


def test_a_query_session_limits_generated_methods_to_what_the_jvm_compiles(spark):
    from civicflow.catalog.queries import _prepare

    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    _prepare(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_the_fixture_derives_a_record_in_compiled_expressions_and_its_time_once(spark):
    import datetime

    from civicflow.sources.service_requests import service_request_records

    events = spark.createDataFrame([(89, 7, "view", datetime.datetime(2024, 1, 31, 10, 20, 30, 500000), 1.25)],
                                   "event_id long, user_id long, event_type string, ts timestamp_ntz, value double")
    records = service_request_records(events, corrections=True)
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    assert plan.count("date_trunc(") == 1
    got = [(r.drop_no, r.created_date, r.closed_date, r.resolution_action_updated_date, r.latitude, r.longitude) for r in records.collect()]
    times = ("2023-11-30T10:20:30", "2023-11-30T11:35:30")
    assert [g[0] for g in got] == [2, 3]  # 89 % 10 = 9: not in drop 1
    assert got[0][1:] == ("2023-11-30T10:20:30", "2023-11-30T05:20:30", "2023-12-02T10:20:30", "40.089000", "-73.911000")
    assert got[1][1:3] == times


def test_fixture_variants_equal_the_parsed_payload(spark):
    from civicflow.sources.service_requests import payload_json, payload_variant, service_request_records
    schema = "event_id bigint, user_id bigint, event_type string, value double, ts timestamp"
    rows = [(e, e * 7 % 50 if e % 17 else None, [None, "view", "click", "error", 'a"b\\é'][e % 5], e / 7 if e % 19 else None, None)
            for e in range(200)] + [(None, 1, "view", 2.0, None), (5, 5, "view", 2.0, None)]
    events = spark.createDataFrame(rows, schema).withColumn("ts", F.when(F.coalesce(F.col("event_id"), F.lit(0)) % 23 != 1, F.lit("2024-01-05 10:00:00").cast("timestamp")))
    records = service_request_records(events)
    both = records.select(F.to_json(F.parse_json(payload_json())).alias("old"), F.to_json(payload_variant()).alias("new"))
    assert both.where("old is null or not (old <=> new)").isEmpty()
    plan = records.select(payload_variant().alias("v"))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "to_variant_object" in plan or "tovariantobject" in plan


def test_fixture_work_is_spread_over_tasks(spark, tmpdir_path):
    from civicflow.sources.service_requests import service_request_records
    path = tmpdir_path + "/events"
    far = F.pmod(F.xxhash64("id"), F.lit(10**12))
    (spark.range(100_000).select(far.alias("event_id"), (far + 1).alias("user_id"), F.lit("view").alias("event_type"), F.rand(1).alias("value"),
                                 F.lit("2024-01-05 10:00:00").cast("timestamp").alias("ts")).coalesce(1).write.parquet(path))
    one = spark.read.parquet(path)  # one file of one row group: only one task can read rows of it
    sizes = service_request_records(one).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(F.hash("*"))).collect()
    assert len(sizes) > 1 and max(r.n for r in sizes) < 0.8 * sum(r.n for r in sizes)
