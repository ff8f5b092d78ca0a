import random

import pytest
from pyspark.sql import functions as F

from civicflow.llm import decontaminate as d
from tests.llm import brute
from tests.llm.helpers import DOCS, docs_frame, edge_texts, rows, sf, tuples, words


def found(df, items):
    out = d.contamination(df, items).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("sha"), (F.col("n_hit") > 0).alias("contaminated"))
    return tuples(out, *out.columns)


def made():
    rng = random.Random(2)
    items = [words(rng, n, 60) for n in (3, 5, 9, 10, 11, 14, 30, 30)]
    items += [items[6][:60] + " " + words(rng, 12, 60), items[4], None, "", "...", "Ünï-code, item: zehn Wörter HIER, drin sind ja 8 9"]
    texts = [words(rng, rng.randrange(1, 80), 60) + rng.choice([" ", ". ", ", "]) + rng.choice([i for i in items if i])
             + " " + words(rng, 9, 60) for _ in range(60)]
    return [(i * 7 % 100, t) for i, t in enumerate(items)], rows(edge_texts() + texts)


@pytest.mark.parametrize("limit", [d.AUTOMATON_WORDS, 10])
def test_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(d, "AUTOMATON_WORDS", limit)  # the second run needs several automata
    items, docs = made()
    got = found(docs_frame(spark, docs, clash=True), spark.createDataFrame(items, "item_id bigint, text string"))
    assert got == sorted(brute.contamination([(r[0], r[1]) for r in docs], items))
    assert sum(r[5] for r in got) > 20


def test_on_tables(spark):
    docs, items = sf(spark, "documents"), sf(spark, "benchmark")
    pairs = lambda df, k: [(r[0], r[1]) for r in df.select(k, "text").collect()]
    assert found(docs, items) == sorted(brute.contamination(pairs(docs, "doc_id"), pairs(items, "item_id")))


def test_cutting(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    long = " ".join(f"w{i}" for i in range(40))
    docs = docs_frame(spark, rows([f"{long}. Alpha, beta gamma delta epsilon zeta eta theta iota kappa lambda! end", f"x {item}", long, None]),
                      clash=True)
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = {r.doc_id: r for r in d.decontaminate(docs, items).collect()}
    assert set(got) == {0, 2, 3}  # the second text is mostly the item
    assert got[0].text == f"{long}. ! end" and got[0].n_chars == len(got[0].text)
    before = {r.doc_id: r for r in docs.collect()}
    assert got[2] == before[2] and got[3] == before[3]


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "some item text")], "item_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert d.contamination(spark.createDataFrame([], DOCS), items).collect() == []
    assert d.decontaminate(spark.createDataFrame([], DOCS), items).collect() == []
    assert all(r.n_hit == 0 and r.item_ids == [] for r in d.contamination(docs_frame(spark), none).collect())


def test_one_automaton_at_a_time(spark, monkeypatch):
    """Ten groups of items are built apart and read one after the other, from either end."""
    monkeypatch.setattr(d, "AUTOMATON_WORDS", 5)
    items, docs = made()
    names = d.automata(spark.createDataFrame(items, "item_id bigint, text string"))
    sizes, alive = [], []
    for back in (False, True):
        lens = []
        for m in d._each(names, back):
            lens.append(len(m.automaton.step))
            alive.append(len(d._LOADED))
        sizes.append(lens)
    assert len(sizes[0]) >= 6 and sizes[1] == sizes[0][::-1] and set(alive) == {1}
    monkeypatch.setattr(d, "HELD_BYTES", 500)  # the texts are held in many parts
    got = found(docs_frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    assert got == sorted(brute.contamination([(r[0], r[1]) for r in docs], items))



