import random

import numpy as np
import pyarrow as pa
import pytest

from civicflow.llm import ngram_join
from civicflow.llm.components import connected_components
from civicflow.llm.ngram_join import near_duplicate_links, near_duplicates, one_of_each, shingle_sets
from tests.llm import brute
from tests.llm.helpers import DOCS, docs_frame, edge_texts, rows, sf, tuples, words


def near_family(rng, n, edits, length=80):
    """An original and n edited copies of it."""
    base = words(rng, length, 5000).split()
    out = [" ".join(base)]
    for _ in range(n):
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(length)] = f"edit{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def families():
    rng = random.Random(3)
    texts = []
    for edits in (1, 2, 3, 4, 5):
        texts += near_family(rng, 12, edits)
    chain = words(rng, 60, 5000).split()  # each links to the next one only
    for i in range(8):
        texts.append(" ".join(chain))
        chain = chain[5:] + words(rng, 5, 5000).split()
    shared = words(rng, 50, 5000)  # a passage in texts that don't link
    texts += [words(rng, 60, 5000) + " " + shared for _ in range(15)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("data", ["edge", "families", "sf"])
def test_against_brute_force(spark, data):
    if data == "sf":
        df = sf(spark, "documents")
        docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    else:
        made = rows(edge_texts() if data == "edge" else families())
        df, docs = docs_frame(spark, made, clash=True), [(r[0], r[1]) for r in made]
    expected = sorted(brute.near_duplicates(docs))
    assert tuples(near_duplicates(df), "doc_id", "n_shingles", "component_id") == expected
    assert any(a != c for a, _, c in expected)


def test_small_flushes_and_buckets_change_nothing(spark, monkeypatch):
    made = rows(families())
    monkeypatch.setattr(ngram_join, "BUCKET_GRAMS", 50)
    assert tuples(near_duplicates(docs_frame(spark, made)), "doc_id", "n_shingles", "component_id") == sorted(
        brute.near_duplicates([(r[0], r[1]) for r in made]))


def test_null_and_repeated_ids(spark):
    text, other = "one two three four five six", "seven eight nine ten eleven twelve"
    df = spark.createDataFrame([(5, text), (None, text), (5, text), (3, text.upper()), (None, other), (None, other)], "doc_id bigint, text string")
    got = sorted(map(tuple, near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 2, 3), (None, 2, 3), (5, 2, 3), (3, 2, 3), (None, 2, None), (None, 2, None)], key=str)
    stay = sorted(map(tuple, one_of_each(df).collect()), key=str)
    assert stay == sorted([(3, text.upper()), (None, other)], key=str)


def test_one_of_each_keeps_columns_and_lone_documents(spark):
    made = rows(edge_texts())
    df = docs_frame(spark, made, clash=True)
    expected = [d for d, _, c in brute.near_duplicates([(r[0], r[1]) for r in made]) if d == c]
    got = one_of_each(df)
    assert got.columns == df.columns
    assert sorted(got.collect()) == sorted(r for r in df.collect() if r.doc_id in expected)


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert near_duplicates(empty).collect() == [] and one_of_each(empty).collect() == []


def test_a_group_of_near_copies_costs_about_as_many_pairs_as_members(spark, monkeypatch):
    rng = random.Random(9)
    made = rows(near_family(rng, 150, 1))
    seen = []
    real = ngram_join._links
    monkeypatch.setattr(ngram_join, "_links", lambda pairs, sets, t: (seen.append(pairs.count()), real(pairs, sets, t))[1])
    out = near_duplicates(docs_frame(spark, made))
    assert {r.component_id for r in out.collect()} == {0}
    assert sum(seen) < 151 * 8  # all pairs would be 11 325


def test_shingles_of_a_slice_do_not_depend_on_its_neighbours():
    texts = edge_texts()
    h, row, digest, _ = shingle_sets(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        alone, _, d, _ = shingle_sets(pa.array([t], pa.string()))
        assert np.array_equal(alone, h[row == i]) and d[0] == digest[i]
        assert len(alone) == len(brute.shingles(t))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for e in edges for x in e if any(a != b and x in (a, b) for a, b in edges)}


@pytest.mark.parametrize("data", ["edge", "families"])
def test_links_against_brute_force(spark, data):
    made = rows(edge_texts() if data == "edge" else families() + families()[:9])
    sets = {}  # set of n-grams -> ids
    for i, text, *_ in made:
        w = (text or "").lower().split()
        grams = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
        if grams:
            sets.setdefault(grams, []).append(i)
    groups = list(sets.items())
    want = {frozenset([(min(x), len(x)), (min(y), len(y))]) for k, (a, x) in enumerate(groups) for b, y in groups[:k]
            if 100 * len(a & b) >= 75 * len(a | b)}
    got = near_duplicate_links(docs_frame(spark, made, clash=True)).collect()
    assert len(got) == len(want) and all(r.a < r.b for r in got)
    assert {frozenset([(r.id_a, r.rows_a), (r.id_b, r.rows_b)]) for r in got} == want


def test_no_pair_is_verified_twice(spark, monkeypatch):
    asked, links = [], ngram_join._links

    def spy(pairs, sets, threshold):
        asked.extend((r.a, r.b) for r in pairs.collect())
        return links(pairs, sets, threshold)

    monkeypatch.setattr(ngram_join, "_links", spy)
    near_duplicates(docs_frame(spark, rows(families())))
    assert asked and len(asked) == len(set(asked))


def test_links_of_an_empty_table(spark):
    assert near_duplicate_links(spark.createDataFrame([], DOCS)).collect() == []
