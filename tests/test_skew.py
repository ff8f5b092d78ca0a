"""Hot keys: a third of all records share one complaint id (and one borough).

The Spark products must still equal the independent SQL oracle built over
the same skewed fixture.
"""

from pyspark.sql import functions as F

from civicflow.catalog.oracle import records_sql, base_sql, clean_sql, daily_summary_sql, dim_borough_sql, \
    dim_type_sql, enriched_sql, fact_rows_sql
from civicflow.catalog.queries import table
from civicflow.plans.build import GoldBuild, materialize
from civicflow.plans.marts import daily_summary
from civicflow.sources.service_requests import AS_OF, payload_json, service_request_records
from tests.oracle_compare import duck, rows_of

SF = "/root/testdata/sf0.01"
HOT = ("case when event_id % 3 = 0 then '777' else unique_key end",
       "case when event_id % 3 = 0 then 'MANHATTAN' else borough end")


def _spark_bronze(spark):
    rec = service_request_records(table(spark, SF, "events"))
    key_num = F.trim(F.col("unique_key")).cast("long")
    is_hot = (key_num % 3 == 0) & F.col("unique_key").isNotNull()
    rec = rec.withColumn("unique_key", F.when(is_hot, F.lit("777")).otherwise(F.col("unique_key"))) \
             .withColumn("borough", F.when(is_hot, F.lit("MANHATTAN")).otherwise(F.col("borough")))
    return rec.select(F.parse_json(payload_json()).alias("raw_data"), "filename", F.col("extracted_at").alias("_extracted_at"),
                      F.lit("S3").alias("_source_relation"))


def _oracle_sr():
    # Same skew on the oracle side: ids whose number is a multiple of 3 collapse to one key.
    return (f"(select * replace ("
            f"case when unique_key is not null and cast(trim(unique_key) as bigint) % 3 = 0 then '777' "
            f"else unique_key end as unique_key, "
            f"case when unique_key is not null and cast(trim(unique_key) as bigint) % 3 = 0 then 'MANHATTAN' "
            f"else borough end as borough) from ({records_sql()}) s)")


def test_hot_key_products_match_oracle(spark):
    g = GoldBuild(spark, materialize(_spark_bronze(spark), "bronze"), AS_OF)
    mart = daily_summary(g.fact, g.dim_b, g.dim_t, AS_OF)
    sr = _oracle_sr()
    clean = clean_sql(base_sql(sr))
    dim_b, dim_t = dim_borough_sql(clean), dim_type_sql(clean)
    fact = fact_rows_sql(enriched_sql(clean), dim_b, dim_t)
    con = duck(SF)
    hot_rows = con.sql(f"select count(*) from {sr} s where unique_key = '777'").fetchall()[0][0]
    total = con.sql(f"select count(*) from {sr} s").fetchall()[0][0]
    assert hot_rows * 3 >= total * 0.9  # about a third of all records share one key
    for df, sql in ((g.clean, clean), (g.fact, fact), (mart, daily_summary_sql(fact, dim_b, dim_t))):
        rel = con.sql(sql)
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())
