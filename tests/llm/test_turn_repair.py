import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicflow.llm.turn_repair import audits, cheapest_edits, damaged, lower_bounds, repair, repaired
from tests.llm import brute
from tests.llm.helpers import sf

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), st.booleans(), st.booleans()), max_size=14))
def test_search_against_uniform_cost_search(rows):
    rows = [(i, go, cut and not go) for i, go, cut in rows]
    assert cheapest_edits(rows) == brute.cheapest_audit(rows)
    assert lower_bounds(rows)[0] <= cheapest_edits(rows)[0]


def test_long_conversations():
    """A long conversation, and one of system turns with exchanges between them, where the lower bound is weakest."""
    rng = random.Random(3)
    long = [(rng.choice("uuaas"), rng.random() < 0.1, False) for _ in range(3000)]
    assert cheapest_edits(long) == brute.cheapest_audit(long)
    weak = [(r, False, False) for r in "sua" * 150]
    assert cheapest_edits(weak) == brute.cheapest_audit(weak)


def check(spark, rows, clash=False):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("digest", "copy", "gone", "audit", "place", "fault", "nth", "initial", "head", "id") if clash else ():
        df = df.withColumn(c, F.lit(7))
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair(df).collect()}
    want = brute.repair(rows)
    assert got == want
    return got


def made():
    rng, out = random.Random(4), []
    texts = ["Hi.", "Why?", "no end", " ", "", "\n\t", "Done! ", "a. ", " ", None, "line.\r\n", "x" * 300_000]
    for c in [*range(60), None]:
        for t in range(rng.randrange(0, 12)):
            for _ in range(1 + (rng.random() < 0.1)):
                out.append((c, None if rng.random() < 0.05 else t, rng.choice(["user", "assistant", "system", "tool", None, "", "user"]), rng.choice(texts)))
    return out


def test_against_brute_force(spark):
    got = check(spark, made(), clash=True)
    assert None in got and any("I" in r[6] for r in got.values()) and any("R" in r[6] for r in got.values())


def test_against_brute_force_on_the_table(spark):
    check(spark, [tuple(r) for r in sf(spark, "conversations").select("conv_id", "turn", "role", "text").collect()])


def test_dropped_conversations_repeats_and_empty_tables(spark):
    gone = [(i, t, "user", "x.") for i in range(400) for t in range(1)]  # one row each, and some are dropped
    got = check(spark, gone)
    empty = [r for r in got.values() if r[6] == ""]
    assert empty and all(r[:6] == (0,) * 6 for r in empty)
    check(spark, [(1, 0, "user", "Same.")] * 5 + [(1, None, "user", "Same.")] * 2)
    assert repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repaired_rows_alternate(spark):
    rows = damaged(sf(spark, "conversations"))
    found = audits(rows)
    by = {}
    for r in repaired(rows, found).collect():
        by.setdefault(r.conv_id, []).append((r.place, r.role[0]))
    for places in by.values():
        roles = "".join(role for _, role in sorted(places))
        roles = roles[1:] if roles[0] == "s" else roles
        assert roles == "ua" * (len(roles) // 2) and roles
