"""Hashes without structural collisions, and what happens when hashes do collide."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civicflow.llm import ngram_join, substring_dedup
from civicflow.llm.bytehash import LOWER, NOT_SPACE, range_hashes, sequence_hashes, word_ranges
from civicflow.llm.decontaminate import contamination
from civicflow.llm.fingerprints import fingerprints
from civicflow.llm.ngram_join import near_duplicates
from civicflow.llm.substring_dedup import remove_repeats
from tests.llm import brute
from tests.llm.helpers import docs_frame, rows, tuples, words


def thue_morse(n, letters="ab"):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word.translate(str.maketrans("ab", letters))


def test_words_of_any_length_and_place():
    rng = random.Random(1)
    made = [bytes(rng.choice(b"abcDEF\xc3\xa9") for _ in range(rng.randrange(1, 150))) for _ in range(3000)]
    data = np.frombuffer(b" ".join(made), np.uint8)
    starts, ends, _ = word_ranges(data, np.array([0, len(data)]), NOT_SPACE)
    h = range_hashes(data, starts, ends)
    assert len(set(zip(made, h.tolist()))) == len(set(made)) == len(set(h.tolist()))
    for i in rng.sample(range(len(made)), 50):
        alone = np.frombuffer(made[i], np.uint8)
        assert range_hashes(alone, np.array([0]), np.array([len(alone)]))[0] == h[i]
    lower = np.frombuffer(b" ".join(w.lower() for w in made), np.uint8)
    assert (range_hashes(data, starts, ends, LOWER) == range_hashes(lower, starts, ends)).all()
    assert (range_hashes(data, starts, ends, seed=1) != h).all()


@pytest.mark.parametrize("n", [8, 16, 64, 1024, 2048])
def test_a_word_and_its_complement(n):
    for letters in ("ab", "0z"):
        a, b = thue_morse(n, letters), thue_morse(n, letters[::-1])
        data = np.frombuffer((a + b).encode(), np.uint8)
        h = range_hashes(data, np.array([0, n]), np.array([n, 2 * n]))
        assert h[0] != h[1]


def test_a_sequence_and_its_complement():
    ids = np.array([11, 99], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for n in (2, 4, 8, 16, 32):
        order = np.array([c == "a" for c in thue_morse(n)], int)
        both = np.r_[ids[order], ids[1 - order]]
        assert len(set(sequence_hashes(both, np.array([0, n]), n).tolist())) == 2


def test_operators_tell_the_pair_apart(spark):
    x, y = thue_morse(2048), thue_morse(2048).translate(str.maketrans("ab", "ba"))
    texts = [" ".join([x] * 25), " ".join([y] * 25), x, y]
    df = docs_frame(spark, rows(texts))
    docs = list(enumerate(texts))
    assert tuples(near_duplicates(df), "doc_id", "n_shingles", "component_id") == sorted(brute.near_duplicates(docs))
    got = tuples(remove_repeats(df).withColumn("sha", F.sha2("kept", 256)), "doc_id", "n_words", "n_removed", "sha")
    assert got == sorted(brute.repeats_removed(docs))
    items = [(1, x), (2, " ".join([y] * 3))]
    hits = contamination(df, spark.createDataFrame(items, "item_id bigint, text string"))
    assert {r.doc_id: (r.n_hit, r.item_ids) for r in hits.collect()} == {d: (h, i) for d, h, i in ((0, 25, ["1"]), (1, 25, ["2"]), (2, 1, ["1"]), (3, 0, []))}
    prints = {r.doc_id: r.fingerprint for r in fingerprints(df).collect()}
    assert len(set(prints.values())) == 4


def test_windows_of_one_hash_are_told_apart_by_the_other():
    """Places whose first hashes all collide: only those that agree in both count as repeats."""
    second = np.array([5, 7, 5, 7, 9], np.uint64)
    h = np.stack([np.full(5, 3, np.uint64), second], axis=1)
    ids, keys, place = np.arange(5), np.arange(5), np.zeros(5, np.int64)
    order = substring_dedup._by_hash(h, ids, keys, place)
    new, later = substring_dedup._elsewhere(h[order], ids[order], keys[order], place[order], True)
    assert sorted(ids[order][later].tolist()) == [2, 3] and sorted(ids[order][new].tolist()) == [0, 1, 4]


def test_sets_of_one_digest_are_told_apart(spark):
    """Rows whose digests collide get their second digest, in the table and in the mappers alike."""
    rows_ = [(1, 1, 3, 7, 100), (2, 2, 3, 7, 200), (3, 3, 3, 7, 100), (4, 4, 2, 8, 300), (5, 5, 0, 0, 0)]
    df = spark.createDataFrame(rows_, "doc_id bigint, key bigint, n_shingles bigint, digest bigint, second bigint")
    sizes, shared = ngram_join._distinct_digests(df)
    assert shared.tolist() == [7] and {r.doc_id: r.digest for r in sizes.collect()} == {1: 100, 2: 200, 3: 100, 4: 8, 5: 0}
    told = ngram_join._told_apart(np.array([7, 7, 8], np.uint64), np.array([100, 200, 300], np.uint64), shared)
    assert told.tolist() == [100, 200, 8]


def hot_line():
    """One line in a third of otherwise different texts, and a family of near copies."""
    rng = random.Random(12)
    line, base = words(rng, 30, 9000), words(rng, 60, 9000)
    texts = [words(rng, 60, 90_000) + ("\n" + line if i % 3 == 0 else "") for i in range(240)]
    return texts + [base + f" x{i}" for i in range(20)], line


def test_a_hot_line_goes_straight_to_its_sets(monkeypatch):
    texts, line = hot_line()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(range(len(texts)), pa.int64()), pa.array(texts)],
                                       names=["doc_id", "key", "text"])
    sized = pa.Table.from_batches(list(ngram_join._sets_of_batches(iter([batch]), 5)))
    hot = np.sort(np.array([g for row in sized["hot"].to_pylist() if row for g in row], np.int64).view(np.uint64))
    in_line = set(ngram_join.shingle_sets(pa.array([line]), 5)[0].tolist())
    assert in_line <= set(hot.tolist())
    packs = pa.Table.from_batches(list(ngram_join._deal(iter([batch]), 5, 16, np.zeros(0, np.uint64), hot, np.full(len(hot), 80))))
    waiting = ngram_join._unpack(packs.filter(pa.compute.is_null(packs["freqs"])))
    straight = packs.filter(pa.compute.is_valid(packs["freqs"]))
    assert not in_line & set(waiting[2].tolist())
    held = np.zeros(16, int)
    for bucket, one in zip(straight["bucket"].to_pylist(), range(len(straight))):
        owner, _, grams, _ = ngram_join._unpack(straight.slice(one, 1))
        held[bucket] += int(np.isin(grams, list(in_line)).sum())
    assert held.sum() == 80 * len(in_line) and held.max() <= 3 * np.median(held)


def test_a_hot_line_changes_no_result(spark):
    texts, _ = hot_line()
    made = rows(texts)
    assert tuples(near_duplicates(docs_frame(spark, made).repartition(3)), "doc_id", "n_shingles", "component_id") == sorted(
        brute.near_duplicates([(r[0], r[1]) for r in made]))


def test_texts_above_a_slice(spark):
    """Texts of more than a slice, and single words of that size."""
    rng = random.Random(5)
    long = words(rng, 230_000, 60_000)
    item = " ".join(long.split()[1000:1030])
    texts = [long, long + " tail", "w" * 1_200_000, "w" * 1_200_000 + " x", item, None]
    assert len(long) > 1 << 20
    df, docs = docs_frame(spark, rows(texts)), list(enumerate(texts))
    assert tuples(near_duplicates(df), "doc_id", "n_shingles", "component_id") == sorted(brute.near_duplicates(docs))
    got = tuples(remove_repeats(df).withColumn("sha", F.sha2("kept", 256)), "doc_id", "n_words", "n_removed", "sha")
    assert got == sorted(brute.repeats_removed(docs))
    hits = contamination(df, spark.createDataFrame([(1, item), (2, "w" * 1_200_000)], "item_id bigint, text string"))
    assert {r.doc_id: r.item_ids for r in hits.collect()} == {0: ["1"], 1: ["1"], 2: ["2"], 3: ["2"], 4: ["1"], 5: []}
