import random

import numpy as np
import pyarrow as pa
import pytest

import civicflow.llm.source_divergence as sd
from tests.llm import brute
from tests.llm.helpers import DOCS, docs_frame, edge_texts, rows, sf


def result(df, **kw):
    got = [(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in sd.divergence(df, **kw).collect()]
    assert len(got) == len(set(got))
    return set(got)


def made(n=160, seed=9):
    rng = random.Random(seed)
    vocabulary = ["cat", "Cat", "cat.", "dog-cat", "été", "Été!", "x1y", "https://a.b/c?d=cat", "日本", "ÀB", " ", "1234", "_"] + [f"w{chr(97 + i)}" for i in range(12)]
    return [(i % 150, " ".join(rng.choice(vocabulary) + rng.choice(["", ",", " x"]) for _ in range(rng.randrange(0, 25))),
             rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "b", "c", "é", None]), 0) for i in range(n)]


@pytest.mark.parametrize("data", ["edge", "made", "sf"])
def test_against_brute_force(spark, data):
    if data == "sf":
        df = sf(spark, "documents")
        docs = [(r.text, r.lang, r.source) for r in df.select("text", "lang", "source").collect()]
    else:
        rs = rows(edge_texts()) if data == "edge" else made()
        df, docs = docs_frame(spark, rs, clash=True), [(r[1], r[2], r[3]) for r in rs]
    k = 2 if data == "edge" else 10
    assert result(df, min_docs=k) == brute.divergence(docs, min_docs=k)


def test_small_flushes_buckets_and_blocks(spark, monkeypatch):
    """Counts cut into many flushes, buckets, tiles and blocks of sources give the same."""
    rs = made(300, 11)
    rs = [(d, t, lang, f"{s}{i % 7}", n) for i, (d, t, lang, s, n) in enumerate(rs)]
    for name, value in (("FLUSH_WORDS", 20), ("BUCKET_BYTES", 100), ("SOURCES_PER_BLOCK", 4), ("TERMS_PER_TILE", 3), ("ENTRIES_PER_BUCKET", 100)):
        monkeypatch.setattr(sd, name, value)
    monkeypatch.setattr("civicflow.llm.common.SLICE_BYTES", 200)
    assert result(docs_frame(spark, rs)) == brute.divergence([(t, lang, s) for _, t, lang, s, _ in rs])


def test_documents_that_hold_a_term_in_several_chunks(spark):
    """Nine documents hold a term by two chunks each: eighteen by chunk, nine in truth; a tenth decides."""
    nine = [(i, "cat cat. dog", "en", f"s{i % 2}", 0) for i in range(9)]
    assert result(docs_frame(spark, nine)) == brute.divergence([(t, g, s) for _, t, g, s, _ in nine]) == {
        ("en", "s0", "pair", "s1", 0, 1), ("en", "s1", "pair", "s0", 0, 1)}
    ten = [*nine, (9, "(cat)", "en", "s1", 0)]
    got = result(docs_frame(spark, ten))
    assert got == brute.divergence([(t, g, s) for _, t, g, s, _ in ten]) and {r[3] for r in got if r[2] == "term"} <= {"cat"}


def packs(texts, task=0, hashes=None):
    flush = sd._Flush()
    flush.add(pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * len(texts)), pa.array(["s"] * len(texts))], names=["text", "lang", "source"]))
    if hashes:
        flush.words = [(hashes(w[0]), *w[1:]) for w in flush.words]
    rows = list(flush.packs(0, task, 1, 10))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), sd._PACK)], schema=sd._PACK)


def test_each_distinct_chunk_is_cut_once(monkeypatch):
    """Chunks that several flushes bring are cut into terms once."""
    calls = []

    class Counting:
        def findall(self, chunk):
            calls.append(chunk)
            return [chunk]

    monkeypatch.setattr(sd, "TERM", Counting())
    out = sd._factor(pa.concat_tables([packs(["a b b", "b"], 0), packs(["b c", "", "c d"], 1)]), 10).to_pylist()
    assert sorted(calls) == [b"a", b"b", b"c", b"d"]
    assert sorted((r["term"], r["ns"], r["docs"], len(set(r["seen"]))) for r in out) == [("a", [1], 1, 1), ("b", [4], 3, 3), ("c", [2], 2, 2), ("d", [1], 1, 1)]


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_chunks_of_one_hash_are_told_apart(bits):
    """With a hash of a few bits nearly all chunks collide; counts and documents stay right."""
    texts = ["a b a c a b", "b a b", "c", "d d a"]
    squash = lambda h: h & np.uint64(2**bits - 1)
    got = sorted((r["term"], r["ns"], r["docs"], sorted(x & 0xFF for x in r["seen"])) for r in sd._factor(packs(texts, hashes=squash), 10).to_pylist())
    assert got == [("a", [5], 3, [0, 1, 3]), ("b", [4], 2, [0, 1]), ("c", [2], 2, [0, 2]), ("d", [2], 1, [3])]


def test_large_counts_stay_exact():
    """Shares of counts far beyond what 64-bit products hold."""
    n, total, v = 3 * 10**12 + 1, 7 * 10**12 + 5, 12345
    assert sd.shares(np.array([n, 0]), np.array([total, total]), v).tolist() == [1 + 10**9 * (x + 2) // (total + 2 * v) for x in (n, 0)]


def test_empty_null_and_single_sources(spark):
    assert result(spark.createDataFrame([], DOCS)) == set()
    nulls = [(None, None, None, None, None)] * 12 + [(1, "only", None, None, 0)] * 12
    assert result(docs_frame(spark, nulls)) == brute.divergence([(t, g, s) for _, t, g, s, _ in nulls])
