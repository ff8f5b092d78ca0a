import random

import pytest
from pyspark.sql import functions as F

from civicflow.llm.queries import op11_secret_ledger
from civicflow.llm.secret_ledger import BASE, RULES, Ledger, Rule, findings, scan_history, update
from tests.llm import brute
from tests.llm.helpers import DOCS, docs_frame, edge_texts, rows, sf

KINDS = {r.kind for r in BASE}


def tricky():
    rng = random.Random(8)
    parts = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", "Api_", "toKen", "ſecret", "=", ":", ": ", ' = "', "'", '"', "AKIA", "ABCDEFGHIJKLMN",
             "0123456789abcdef", "deadbeef", "Zz09+/_.=-", "abcdefghijkl", "x", " ", "\n", "é", "-", "==", "日本", "A", "AKIAAKIA", "9" * 15]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    return texts + ["token=secret:abcdefghijklmnop", "a" * 60_000, "token=" * 9_000, "AKIA" * 9_000, "password " * 9_000, "eyJ" * 9_000, "g" * 15 + "0" * 15 + "g"]


def spans(row):
    return [(s.start, s["rank"], s.end, s.kind) for s in row.spans]


@pytest.mark.parametrize("data", ["edge", "tricky", "sf"])
def test_base_spans_against_brute_force(spark, data):
    if data == "sf":
        df = sf(spark, "documents")
        docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    else:
        made = rows(edge_texts() if data == "edge" else tricky())
        df, docs = docs_frame(spark, made, clash=True).withColumn("blob", F.lit("x")).withColumn("spans", F.lit("x")), [(r[0], r[1]) for r in made]
    got = {r.doc_id: r for r in scan_history(df).collect()}
    assert len(got) == len(docs)
    for d, t in docs:
        assert [s for s in spans(got[d]) if s[3] in KINDS] == brute.secrets(t), t[:200]
        assert spans(got[d]) == sorted(spans(got[d]))


def test_added_formats(spark):
    texts = ["x ghp_" + "a1B2" * 9 + " y", "eyJhbGciOi.eyJzdWIiOi.c2lnbmF0dXJl", "-----BEGIN RSA PRIVATE KEY-----", "postgres://u:hunter2@db/x",
             "http://example.com:80/a@b", "ghp_short", "eyJ alone", "BEGIN PRIVATE KEY"]
    got = {r.doc_id: [s[3] for s in spans(r)] for r in scan_history(docs_frame(spark, rows(texts))).collect()}
    assert [got[i] for i in range(8)] == [["github"], ["jwt"], ["pem"], ["login"], [], [], [], []]


def test_only_unseen_pairs_are_scanned(spark, tmpdir_path):
    """Copies, reverted texts and reruns scan nothing; a new rule version is run alone and replaces the old findings."""
    ledger = Ledger(spark, f"{tmpdir_path}/ledger")
    frame = lambda rs: spark.createDataFrame(rs, "path string, version int, text string")
    first = frame([("a", 1, "token=abcdefghijkl"), ("b", 1, "plain"), ("c", 1, "plain"), ("d", 1, None)])
    assert update(first, ledger) == 3 and update(first, ledger) == 0
    later = frame([("a", 1, "token=abcdefghijkl"), ("a", 2, "gone"), ("a", 3, "token=abcdefghijkl"), ("e", 1, "plain"), ("d", 2, "")])
    assert update(later, ledger) == 1
    got = {(r.path, r.version): spans(r) for r in findings(later, ledger).collect()}
    assert got[("a", 1)] == got[("a", 3)] == [(0, 0, 18, "assign")] and got[("a", 2)] == got[("e", 1)] == []
    newer = tuple(Rule("access", 2, "gone", "contains(text, 'gone')") if r.kind == "access" else r for r in RULES)
    assert update(later, ledger, newer) == 4
    last = ledger.rows().where("size(scanned) = 1").collect()
    assert {s.kind for r in last for s in r.scanned} == {"access"} and {s.version for r in last for s in r.scanned} == {2}
    assert [spans(r) for r in findings(later, ledger, newer).where("path = 'a' and version = 2").collect()] == [[(0, 1, 4, "access")]]
    assert [spans(r) for r in findings(later, ledger).where("path = 'a' and version = 2").collect()] == [[]]


def test_a_stopped_scan_is_made_again(spark, tmpdir_path):
    ledger = Ledger(spark, f"{tmpdir_path}/ledger")
    docs = docs_frame(spark, rows(["token=abcdefghijkl"]))
    bad = (Rule("bad", 1, "x", "raise_error('stopped') is null"),)
    with pytest.raises(Exception, match="stopped"):
        update(docs, ledger, bad)
    assert ledger.scans() == [] and update(docs, ledger) == 1


def test_both_ways_to_the_texts_agree(spark, monkeypatch):
    docs = docs_frame(spark, rows(tricky()[:60] * 3))
    wide = {r.doc_id: spans(r) for r in scan_history(docs).collect()}
    monkeypatch.setattr("civicflow.llm.secret_ledger.BROADCAST_BLOBS", 0)
    assert {r.doc_id: spans(r) for r in scan_history(docs).collect()} == wide


def test_empty_null_and_repeated_rows(spark):
    assert scan_history(spark.createDataFrame([], DOCS)).collect() == []
    twice = spark.createDataFrame([(1, "token=abcdefghijkl"), (1, "token=abcdefghijkl"), (None, "token=abcdefghijkl"), (None, None)], "doc_id bigint, text string")
    assert sorted(len(r.spans) for r in scan_history(twice).collect()) == [0, 1, 1, 1]


def test_query_columns(spark):
    assert op11_secret_ledger(spark, "/root/testdata/sf0.001").columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
