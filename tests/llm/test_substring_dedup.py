import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civicflow.llm import substring_dedup
from civicflow.llm.substring_dedup import COVER, PERIOD, WINDOW, remove_repeats
from tests.llm import brute
from tests.llm.helpers import DOCS, docs_frame, edge_texts, rows, sf, tuples, words

COLS = ("doc_id", "n_words", "n_removed", "sha")


def result(df):
    return tuples(remove_repeats(df).withColumn("sha", F.sha2("kept", 256)), *COLS)


def passages():
    """Passages around the window's length, at every shift, within and across texts."""
    rng = random.Random(8)
    common = [words(rng, n, 9000) for n in (19, 20, 21, 25, 33, 60)]
    out = []
    for i in range(60):
        parts = [words(rng, rng.randrange(0, 30), 9000)]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(common), words(rng, rng.randrange(0, 15), 9000)]
        out.append(" ".join(p for p in parts if p))
    out.append(" ".join([common[4]] * 4))
    out.append(" ".join(["same"] * 100))
    out += [out[0], out[5], out[60]]
    return out


def test_the_cover_meets_every_shift():
    assert all(any((i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER for d in range(PERIOD))
               for i in range(PERIOD) for j in range(PERIOD))
    assert substring_dedup.ANCHOR + PERIOD - 1 == WINDOW


@pytest.mark.parametrize("data", ["edge", "passages", "sf"])
def test_against_brute_force(spark, data):
    if data == "sf":
        df = sf(spark, "documents")
        docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    else:
        made = rows(edge_texts() if data == "edge" else passages())
        df, docs = docs_frame(spark, made, clash=True), [(r[0], r[1]) for r in made]
    expected = sorted(brute.repeats_removed(docs))
    assert result(df) == expected
    assert any(r[2] for r in expected)


def test_small_flushes_change_nothing(spark, monkeypatch):
    made = rows(passages())
    monkeypatch.setattr(substring_dedup, "FLUSH_PLACES", 40)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 500)
    assert result(docs_frame(spark, made)) == sorted(brute.repeats_removed([(r[0], r[1]) for r in made]))


def test_repeated_rows_are_one_document_and_null_ids_come_last(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got = result(spark.createDataFrame([(7, text), (7, text), (None, text), (9, text), (None, None)], "doc_id bigint, text string"))
    assert [(r[0], r[1], r[2]) for r in got] == [(7, 30, 0), (7, 30, 0), (9, 30, 30), (None, 0, 0), (None, 30, 30)]


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], DOCS)).collect() == []


def test_copies_of_a_text_are_dealt_over_all_buckets():
    n, buckets, text = 4000, 16, " ".join(f"w{i}" for i in range(30))
    batch = pa.RecordBatch.from_pydict({"id": list(range(n)), "key": [12345] * n, "text": [text] * n})
    own = np.zeros(buckets, np.int64)  # copies that a mapper sends to each bucket of documents
    for pack in substring_dedup._anchors(iter([batch]), buckets):
        for bucket, ids, h in zip(*(pack.column(c).to_pylist() for c in ("bucket", "ids", "hashes"))):
            own[bucket] += len(ids) // 8 if h is None else 0
    assert own.sum() == n - 1 and own.max() < 2 * n / buckets
    # the same for what a bucket of hashes deals on: an anchor that all documents hold
    ids = np.arange(n)
    packs = substring_dedup._packs(np.zeros(n, np.int32), ids, ids, np.full(n, 12345), np.zeros(n, np.int64), np.full(n, 7, np.uint64))
    settled = substring_dedup._settle(pa.Table.from_batches([packs]), False, buckets)
    sizes = [len(x) // 8 for x in settled.column("ids").to_pylist()]
    assert sum(sizes) == n and max(sizes) < 2 * n / buckets
