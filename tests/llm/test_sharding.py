from collections import Counter

import pytest
from pyspark.sql import functions as F

from civicflow.llm.sharding import SHARDS, SLOTS, fill, place, slot_of, walk
from tests.llm.helpers import DOCS, docs_frame, sf


def test_every_shard_has_as_many_slots():
    count = Counter(fill())
    assert set(count) == set(SHARDS) and max(count.values()) - min(count.values()) <= 1 and sum(count.values()) == SLOTS


def test_claims_follow_the_turns():
    shards, slots = ("a", "b", "c"), 13
    free, want = set(range(slots)), [None] * slots
    order = {s: [(walk(s, slots)[0] + k * walk(s, slots)[1]) % slots for k in range(slots)] for s in shards}
    turn = 0
    while free:
        s = shards[turn % 3]
        slot = next(x for x in order[s] if x in free)
        free.discard(slot)
        want[slot] = s
        turn += 1
    assert fill(shards, slots) == want


def test_a_shard_less_moves_few_other_slots():
    old, new = fill(SHARDS), fill(SHARDS[:-1])
    moved = sum(a != b for a, b in zip(old, new) if a != SHARDS[-1])
    assert moved < 0.15 * SLOTS


def test_bad_parameters():
    for shards, slots in (((), 13), (("a",), 12), (("a", "b", "c"), 2), (("a", "a"), 13)):
        with pytest.raises(ValueError):
            fill(shards, slots)


def test_placement(spark):
    table = fill()
    df = sf(spark, "documents")
    got = place(df).collect()
    assert len(got) == df.count() and all(r.shard == table[r.slot] for r in got)
    repeated = docs_frame(spark, [(1, "a", None, None, 1), (1, "b", None, None, 1), (None, "c", None, None, 1), (None, "d", None, None, 1)], clash=True)
    rows = place(repeated).collect()
    assert len(rows) == 4 and len({r.shard for r in rows if r.doc_id == 1}) == 1 and len({r.shard for r in rows if r.doc_id is None}) == 1
    assert place(repeated).columns == [c for c in repeated.columns if c != "slot"] + ["slot", "shard"]
    assert place(spark.createDataFrame([], DOCS)).collect() == []


def test_slots_are_spread(spark):
    count = Counter(r.slot for r in spark.range(50_000).select(slot_of(F.col("id"), SLOTS).alias("slot")).collect())
    assert len(count) > 0.99 * SLOTS
