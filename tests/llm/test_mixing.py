import random
from collections import Counter

import pytest

from civicflow.llm.mixing import mix, mixed_documents
from tests.llm import brute
from tests.llm.helpers import DOCS, docs_frame, edge_texts, rows, sf, tuples, words


def many():
    rng = random.Random(4)
    sources = ["a", "b", "B", "é", None, "hot", "hot", "hot", "tiny"]
    return [(i, words(rng, rng.choice([0, 1, 5, 40, 300])) if i % 31 else None, "en", sources[i % 9] if i != 8 else "tiny", 1) for i in range(700)
            if sources[i % 9] != "tiny" or i < 40]


@pytest.mark.parametrize("data", ["edge", "many", "sf"])
def test_targets_and_words_taken(spark, data):
    df = {"edge": lambda: docs_frame(spark, rows(edge_texts()), clash=True), "many": lambda: spark.createDataFrame(many(), DOCS),
          "sf": lambda: sf(spark, "documents")}[data]()
    docs = df.select("doc_id", "text", "source").collect()
    size = {r.doc_id: len(brute.SPACE_WORD.findall(r.text or "")) for r in docs}
    of_source = Counter()
    for r in docs:
        of_source[r.source] += size[r.doc_id]
    want, taken = brute.targets(dict(of_source)), Counter()
    got = mix(df).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.size, r.source_size) == (size[r.doc_id], of_source[r.source])
        assert r.target == pytest.approx(float(want[r.source]))
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in of_source)
    assert tuples(mix(df), "doc_id", "taken") == sorted((r.doc_id, r.taken) for r in got)  # reruns agree


def test_clamping_cascades(spark):
    data = [(i, "w " * n, "en", s, 1) for i, (s, n) in enumerate([("a", 600), ("b", 10), ("c", 10), ("d", 100), ("e", 3)])]
    got = {r.source: (r.target, r.epochs) for r in mix(spark.createDataFrame(data, DOCS)).collect()}
    want = brute.targets({"a": 600, "b": 10, "c": 10, "d": 100, "e": 3})
    assert {s: t for s, (t, _) in got.items()} == pytest.approx({s: float(t) for s, t in want.items()})
    assert [got[s][1] for s in "bce"] == [3, 3, 3]


def test_repeated_documents(spark):
    df = spark.createDataFrame(many(), DOCS)
    for c in ("order", "times", "row", "of"):
        df = df.withColumn(c, df.doc_id)
    plan = {r.doc_id: r for r in mix(df).collect()}
    out = mixed_documents(df)
    assert out.columns == df.columns
    times = Counter(r.doc_id for r in out.select("doc_id").collect())
    assert {r for r in out.collect()} <= {r for r in df.collect()}
    for d, r in plan.items():
        expected = r.epochs + (2 * r.sampled >= r.size) if r.size else 1
        assert times[d] == expected, r


def test_empty_and_wordless(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mix(empty).collect() == [] and mixed_documents(empty).collect() == []
    blank = docs_frame(spark, rows([None, "", " "]))
    assert [(r.size, r.target, r.taken) for r in mix(blank).collect()] == [(0, 0.0, 0)] * 3


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c", "en", "s", 5)] * 6 + [(None, "d e", "en", "t", 3)] * 4, DOCS)
    got = mix(df).collect()
    assert len(got) == 10
    assert sum(r.taken for r in got if r.source == "s") == round(next(r.target for r in got if r.source == "s"))
