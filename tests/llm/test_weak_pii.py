import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from civicflow.llm.weak_pii import LABELERS, Labels, find_spans, spelled, train_classifier
from tests.llm import brute
from tests.llm.helpers import DOCS, docs_frame, edge_texts, rows, sf


def tricky():
    rng = random.Random(6)
    parts = ["a@b.c", "x.y+z@mail.example.com", "a@b.c_d@e.fg", "@x.y", "a@@b.c", "a@b", "a@b.c.", "..@..x", "1.2.3.4", "256.1.1.1", "1.2.3", "1.2.3.4.5.6.7.8",
             "001.002.003.004", "99999999999.1.1.1", "1..2.3.4", "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111",
             "12345678901234", "0" * 19, "0" * 20, "+1 (319) 555-5132", "+33.1.23.45.67.89", "+1", "+12", "+1234567890123456", "++1 555 123 4567",
             "+1 555 123 45-(", "é", "日本", "\n", "\t", " ", "-", "(", ".", "word", "7", "12", "@", "+", "%", "_"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "", "\n", ", "]) for _ in range(rng.randrange(1, 25))) for _ in range(300)]
    texts += [" ".join(f"{i % 300}.2.3.4 u{i}@h{i}.com" for i in range(900)), "a" * 50_000 + "@b.c", "1" * 30_000, "1 " * 20_000, "a." * 20_000 + "@x.y",
              "x@" + "y." * 20_000 + "z", "+1" + "(" * 20_000 + "2345678901"]
    return texts


def check(df, docs):
    rows_, _, _ = find_spans(df)
    got = {r.doc_id: r for r in rows_.select("doc_id", "base", F.sha2(spelled("base"), 256).alias("sha"), "added").collect()}
    assert len(got) == len(docs)
    for d, t in docs:
        want = brute.pii(t)
        assert [(s.start, s["rank"], s.end, s.kind) for s in got[d].base] == want, t[:200]
        assert got[d].sha == hashlib.sha256(brute.spelled(want).encode()).hexdigest()
        assert all(s.value == t[s.start:s.end] for s in got[d].base + got[d].added)
        assert not any(a.start < b.end and b.start < a.end for a in got[d].added for b in got[d].base)
    return got


@pytest.mark.parametrize("data", ["edge", "tricky", "sf"])
def test_base_spans_against_brute_force(spark, data):
    if data == "sf":
        df = sf(spark, "documents")
        docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    else:
        made = rows(edge_texts() if data == "edge" else tricky())
        df, docs = docs_frame(spark, made, clash=True), [(r[0], r[1]) for r in made]
    got = check(df, docs)
    if data == "sf":
        assert any(r.added for r in got.values())


def test_planted_secrets_and_numbers_are_found_and_clean_text_is_left(spark):
    """Spans that the classifier adds, against what the tables are known to hold: assigned literals and numbers written like cards."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    rows_, _, _ = find_spans(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    added = {(r.doc_id, s.kind, s.value) for r in rows_.collect() for s in r.added}
    secrets = {(d, "secret", v) for d, t in docs.items() for v in re.findall(r'token = "([0-9a-f]{40})"', t)}
    assert len(secrets) >= 10 and secrets <= added
    assert {kind for _, kind, _ in added} <= {"secret", "account"}
    assert all(re.fullmatch("[0-9]{16}", v) for _, kind, v in added - secrets if kind == "account")
    assert len(added - secrets) <= 0.2 * len(added)


def test_candidates_that_are_refused(spark):
    """Stand-ins, words, and numbers that context speaks against."""
    good = [f'config token = "{i:02d}beb58b8af68854f0e01b4ad40cdbb6ae7f578a" end' for i in range(30)]
    bad = ["password = changeme12345", "token: yourtokenhere1", "secret = abcdefghijklmnop", "order no. 4000123412341234 shipped", "id x4000123412341234y",
           "0000000000000000", "9999 1234 5678 9012 3456"]
    texts = good + bad
    got = check(docs_frame(spark, rows(texts)), list(enumerate(texts)))
    added = {i: [s.value for s in r.added] for i, r in got.items() if r.added}
    assert set(range(30)) <= set(added) and not {30, 31, 32, 34, 35, 36} & set(added)


def test_the_classifier_adds_looser_spans_and_leaves_clean_text(spark):
    pii = [f"mail u{i}@host.com or call +1 (212) 555-{1000 + i}, card 4111111111111111, server 10.0.0.{i}" for i in range(40)]
    loose = ["please call (212) 555-0123 today", "phone: 212-555-0199.", "write to jane.doe (at) example.org please"]
    clean = ["license version 2.0 of 2004", "nothing here", "part 212-555-0199x7", "release 1.2.3.400 of 300 items", "look at example.com"]
    texts = pii + loose + clean
    got = check(docs_frame(spark, rows(texts)), list(enumerate(texts)))
    added = {i: [s.value for s in r.added] for i, r in got.items() if r.added}
    assert added == {40: ["(212) 555-0123"], 41: ["212-555-0199"], 42: ["jane.doe (at) example.org"]}


def test_labeler_reliabilities_are_recovered():
    """EM finds which of the labelers are better than others."""
    rng = random.Random(1)
    right = [0.95, 0.9, 0.8, 0.7, 0.6, 0.55]
    counts = {}
    for _ in range(20_000):
        y = rng.random() < 0.6
        p = "".join("1" if (rng.random() < a) == y else "2" for a in right)
        counts[p] = counts.get(p, 0) + 1
    labels = Labels(counts)
    assert labels.share == pytest.approx(0.6, abs=0.05)
    for k, a in enumerate(right):
        assert labels.like[k][1][1] == pytest.approx(a, abs=0.06)
    weights = train_classifier(counts, labels)
    assert len(weights) == len(LABELERS) + 1 and weights[1] > weights[6] > -0.2


def test_empty_and_repeated_rows(spark):
    assert find_spans(spark.createDataFrame([], DOCS))[0].collect() == []
    twice = spark.createDataFrame([(1, "x@y.zz"), (1, "x@y.zz"), (None, "x@y.zz"), (None, None)], "doc_id bigint, text string")
    got = find_spans(twice)[0].collect()
    assert sorted(len(r.base) for r in got) == [0, 1, 1, 1]
