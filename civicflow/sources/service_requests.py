"""SR fixture: service-request records derived from the driver's ``events`` table.

Every event becomes one record in drop 1 unless ``event_id % 10 = 9``; events
with ``event_id % 10`` in (0, 9) are (re)delivered in drop 2 with a changed
status and resolution.  Requests spread over three months.  The shaping produces
null and padded keys, bad dates, blank and missing close times, closings before
creation, placeholder boroughs, blank and unlisted types, swapped, out-of-range
and unparseable coordinates, and both absent keys and JSON nulls, so every
cleaning rule is exercised.  The work scales with ``events``: one scan, one
``explode`` for the drops, and one shuffle that spreads the events' five columns over all tasks.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.fixed_values import RECORD_KEYS, SOURCE_TAG

# Keys of the JSON payload (the last columns of the flat fixture are load metadata).
PAYLOAD_KEYS = RECORD_KEYS

AS_OF = "2024-02-03 00:00:00"
DROP_LOADED_AT = {1: "2024-02-01 05:00:00", 2: "2024-02-02 05:00:00", 3: "2024-02-03 05:00:00"}


def _iso(ts: Column) -> Column:
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))


def _times(interval: str, n: Column) -> Column:
    return F.expr(f"interval {interval}") * n.cast("int")


def _thousandths(n: Column) -> Column:
    """``n / 1000`` spelled with six decimals."""
    return (n.cast("decimal(10,0)") * F.lit(Decimal("0.001000"))).cast("decimal(18,6)").cast("string")


def service_request_records(events: DataFrame, repaired: bool = False, corrections: bool = False) -> DataFrame:
    """Flat SR records (all strings) plus ``filename``, ``extracted_at`` and ``drop_no``.

    Ids divisible by 89 close before they were created, which an ``error`` check refuses.  ``repaired`` records have the
    closings that these should have had; with ``corrections`` a third drop redelivers just these ids so.
    """
    eid = F.col("event_id")
    in_drop = {1: eid % 10 != 9, 2: (eid % 10).isin(0, 9), 3: eid % 89 == 0}
    drops = F.array(*[F.when(in_drop[d], F.lit(d)) for d in ((1, 2, 3) if corrections else (1, 2))])
    created = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz") - _times("31 days", eid % 3)
    # A record costs far more than its event, and the table's file may have fewer row groups than there are cores (or uneven ones).
    spread = events.select("event_id", "user_id", "event_type", "value", "ts").hint("repartition")
    e = spread.select("event_id", "user_id", "event_type", "value", created.alias("created"), drops.alias("drops"))
    e = e.select("event_id", "user_id", "event_type", "value", "created", F.explode("drops").alias("drop_no")).where("drop_no is not null")
    c_ts = F.col("created")
    uid = F.col("user_id")
    one_of = lambda options, at: F.element_at(F.array(*[F.lit(v).cast("string") for v in options]), (at + 1).cast("int"))
    d_ts = c_ts + _times("1 minute", F.floor(F.col("value") * 60))
    etype = F.col("event_type")
    drop1 = F.col("drop_no") == 1
    return e.select(
        F.when(eid % 101 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.when(eid % 13 == 0, F.lit(" ")).otherwise(F.lit("")), eid.cast("string")))
         .alias("unique_key"),
        F.when(eid % 97 == 0, F.lit("not-a-date")).otherwise(_iso(c_ts)).alias("created_date"),
        F.when((etype == "view") & drop1, F.lit(""))
         .when(etype == "error", F.lit(None).cast("string"))
         .when((eid % 89 == 0) & (F.col("drop_no") < (0 if repaired else 3)), _iso(c_ts - F.expr("interval 5 hours")))
         .otherwise(_iso(d_ts)).alias("closed_date"),
        F.when((etype == "view") & drop1, F.lit("OPEN"))
         .when(etype == "error", F.lit("in progress"))
         .when(etype == "signup", F.lit(" closed "))
         .when((etype == "click") & (eid % 50 == 0), F.lit("Unspecified"))
         .otherwise(F.lit("Closed")).alias("status"),
        F.element_at(F.array(*[F.lit(v) for v in (
            "HEAT/HOT WATER", "noise - street/sidewalk", " Illegal Parking ", "Rodent", "Water Leak", "",
            "Mystery Type", "NOISE")]), (eid % 8 + 1).cast("int")).alias("complaint_type"),
        F.element_at(F.array(*[F.lit(v) for v in (
            "MANHATTAN", "BROOKLYN", "queens ", "BRONX", "STATEN ISLAND", "Unspecified", " n/a ")]),
            (F.col("user_id") % 7 + 1).cast("int")).alias("borough"),
        F.when(eid % 83 == 0, F.lit("x"))
         .otherwise(_thousandths(F.lit(40000) + eid % 1250))
         .alias("latitude"),
        _thousandths(F.when(eid % 11 == 0, 40000).otherwise(-74000) + eid % 500).alias("longitude"),
        F.when(eid % 7 != 0, _iso(c_ts + _times("1 day", F.col("drop_no")))).alias("resolution_action_updated_date"),
        one_of(("Police", " Transportation", ""), eid % 3).alias("agency_name"),
        one_of(("loud music/party", "POTHOLE", " no access", "", None), eid % 5).alias("descriptor"),
        F.when(eid % 6 != 1, F.when(drop1, "Under review").otherwise(" Work completed ")).alias("resolution_description"),
        F.concat(uid.cast("string"), F.lit(" MAIN STREET")).alias("incident_address"),
        F.when(uid % 4 == 0, "").otherwise(" MAIN STREET ").alias("street_name"),
        one_of(("NEW YORK", "brooklyn ", None), uid % 3).alias("city"),
        F.lpad((uid % 18).cast("string"), 2, "0").alias("community_board"),
        F.when(uid % 9 == 0, "").otherwise((uid % 51 + 1).cast("string")).alias("council_district"),
        F.element_at(F.array(F.lit("NYPD"), F.lit(" DOT "), F.lit("")), (eid % 3 + 1).cast("int")).alias("agency"),
        F.element_at(F.array(F.lit("ONLINE"), F.lit("phone"), F.lit("")), (eid % 3 + 1).cast("int"))
         .alias("open_data_channel_type"),
        F.concat(F.lit("0"), (F.lit(1000) + F.col("user_id")).cast("string")).alias("incident_zip"),
        F.concat(F.lit("source/2024-02-0"), F.col("drop_no").cast("string"), F.lit("/batch"),
                 (eid - eid % 1000).cast("string"), F.lit(".json")).alias("filename"),
        F.element_at(F.create_map(*[x for d, at in DROP_LOADED_AT.items() for x in (F.lit(d), F.lit(at).cast("timestamp_ntz"))]), F.col("drop_no"))
         .alias("extracted_at"),
        F.col("drop_no"),
    )


def _nulls_spelled() -> Column:
    return F.trim("unique_key").cast("long") % 2 == 1


def payload_json() -> Column:
    """A record as JSON.  A NULL is an absent key, or in every other record a JSON null (the key itself is never a JSON null)."""
    record = F.struct(*[F.col(k) for k in PAYLOAD_KEYS])
    return F.when(_nulls_spelled(), F.to_json(record, {"ignoreNullFields": "false"})).otherwise(F.to_json(record))


def payload_variant() -> Column:
    """``parse_json(payload_json())``, which only records with an absent key go through: the others are objects of all keys."""
    record = F.struct(*[F.col(k) for k in PAYLOAD_KEYS])
    whole = _nulls_spelled() | reduce(and_, [F.col(k).isNotNull() for k in PAYLOAD_KEYS])
    return F.when(whole, F.to_variant_object(record)).otherwise(F.parse_json(payload_json()))


def service_request_bronze(events: DataFrame, drops: tuple[int, ...] = (1, 2), repaired: bool = False) -> DataFrame:
    """Bronze rows for the SR fixture: the payload packed into a variant, plus lineage."""
    rec = service_request_records(events, repaired, corrections=3 in drops)
    if tuple(drops) != (1, 2):
        rec = rec.filter(F.col("drop_no").isin(*drops))
    return rec.select(
        payload_variant().alias("raw_data"),
        F.col("filename"),
        F.col("extracted_at").alias("_extracted_at"),
        F.lit(SOURCE_TAG).alias("_source_relation"),
    )
