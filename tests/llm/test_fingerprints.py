import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from civicflow.llm import fingerprints as fp
from civicflow.llm.bytehash import range_hashes
from tests.llm import brute
from tests.llm.helpers import DOCS, docs_frame, edge_texts, rows, sf, words


def expected(docs):
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] if d[0] is not None else 0), reverse=True)
    out = {}
    for k, (d, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 3
        edit = t[:len(t) - n] + after[:n]
        out[d] = (len(t), hashlib.sha256(edit.encode()).hexdigest(), t, edit, after)
    return out


def cut(text):
    """The pieces as words: a line's end ends one, and so does a word whose hash says so."""
    out, piece = Counter(), []
    for line in text.split("\n"):
        for w in brute.SPACE_WORD.findall(line):
            raw = np.frombuffer(w.encode(), np.uint8)
            piece.append(w)
            if int(range_hashes(raw, np.array([0]), np.array([len(raw)]))[0] >> np.uint64(40)) % fp.CUT_ONE_IN == 0:
                out[tuple(piece)] += 1
                piece = []
        if piece:
            out[tuple(piece)] += 1
            piece = []
    return out


def like(a, b):
    x, y = cut(a), cut(b)
    total = sum(x.values()) + sum(y.values())
    return 1 - (sum((x - y).values()) + sum((y - x).values())) / total if total else 1.0


@pytest.mark.parametrize("data", ["edge", "sf", "buckets"])
def test_against_brute_force(spark, monkeypatch, data):
    if data == "buckets":
        monkeypatch.setattr(fp, "BUCKET_BYTES", 2000)
    if data == "edge":
        made = [(r[0] * 1000 - 5, *r[1:]) for r in rows(edge_texts())] + [(None, "the last", "en", "s", 8)]
        df, docs = docs_frame(spark, made, clash=True), [(r[0], r[1]) for r in made]
    else:
        df = sf(spark, "documents")
        docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want, got = expected(docs), fp.fingerprints(df).collect()
    assert len(got) == len(docs)
    for r in got:
        n, sha, text, edit, after = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(like(text, edit)) and r.near_next == pytest.approx(like(text, after))
    by_text = {}
    for r in got:
        by_text.setdefault(want[r.doc_id][2], set()).add(r.fingerprint)
        by_text.setdefault(want[r.doc_id][3], set()).add(r.edited_fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    if data == "sf":
        assert np.mean([r.near_edited > r.near_next for r in got]) > 0.95


def test_peeling_recovers_the_differing_pieces():
    rng = random.Random(3)
    base = words(rng, 3000, 9000)
    versions = [base, base.replace("w7", "v7"), base + " " + base[:400], "", words(rng, 10)]
    a, b = fp.pieces(versions), fp.pieces(versions[1:] + versions[:1])
    digest, row, sign = fp.differing(a, b, len(versions))
    for i in range(len(versions)):
        x, y = set(a[0][a[1] == i].tolist()), set(b[0][b[1] == i].tolist())
        mine = row == i
        assert {(d, s) for d, s in zip(digest[mine].tolist(), sign[mine].tolist())} == {(d, 1) for d in x - y} | {(d, -1) for d in y - x}


def test_stuck_tables_are_retried_larger():
    a, b = fp.pieces([words(random.Random(1), 4000, 9000)]), fp.pieces(["other"])
    assert not fp.sketch(*a, 1).minus(fp.sketch(*b, 1)).peel()[3][0]  # far more pieces than cells
    assert len(fp.differing(a, b, 1)[0]) == len(a[0]) + len(b[0])


def test_an_edit_leaves_other_pieces_alone():
    rng = random.Random(2)
    lines = [words(rng, 12) for _ in range(50)]
    x = set(fp.pieces(["\n".join(lines)])[0].tolist())
    lines[20] = "changed " + lines[20]
    y = set(fp.pieces(["\n".join(lines)])[0].tolist())
    assert 0 < len(x ^ y) <= 4


def test_single_empty_and_repeated(spark):
    assert fp.fingerprints(spark.createDataFrame([], DOCS)).collect() == []
    one = fp.fingerprints(docs_frame(spark, [(1, "a b c d e f", "en", "s", 11)])).first()
    assert one.near_next == 1.0 and one.n_chars == 11 and one.edited_sha256 == hashlib.sha256(b"a b c d a b").hexdigest()
    same = fp.fingerprints(docs_frame(spark, [(1, "x y z", "en", "s", 5)] * 3 + [(None, None, None, None, None)] * 2)).collect()
    assert len(same) == 5 and len({r.fingerprint for r in same}) == 2
    # Of equal rows all but the last have an equal row next; the last one has the NULL text, and the NULLs end at the first row.
    assert sorted(r.near_next for r in same) == [0.0, 0.0, 1.0, 1.0, 1.0]


def test_repeated_rows_are_compared_once(spark, monkeypatch):
    """A third of all rows NULL and empty, another one copied: right neighbours, and no range holds what repeats."""
    monkeypatch.setattr(fp, "BUCKET_BYTES", 200)
    made = [(None, None, None, None, None)] * 300 + [(7, "the same text again", "en", "s", 1)] * 300 + [
        (i, f"text number {i} of many", "en", "s", 1) for i in range(100, 400)]
    got = fp.fingerprints(docs_frame(spark, made).repartition(5)).collect()
    assert len(got) == len(made)
    last = sorted((r.near_next for r in got if r.doc_id == 7))
    assert last[0] == 0.0 and last[1:] == [1.0] * 299
    assert sorted(r.near_next for r in got if r.doc_id is None)[1:] == [1.0] * 299
    want = expected([m[:2] for m in made[600:] + [made[300], made[0]]])
    assert all((r.n_chars, r.edited_sha256) == want[r.doc_id][:2] for r in got if r.doc_id is not None and r.doc_id != 7)


def test_sparse_ids_make_no_large_range(spark):
    """One id far away and a third NULL: ranges are cut by the rows, not by the width of the ids."""
    ids = [2**62, *range(0, 600, 3), *([None] * 100), -2**61]
    made = [(d, f"w{k} " * 30, "en", "s", 1) for k, d in enumerate(ids)]
    down = np.array([~(-2**63 if d is None else d) for d in ids])
    key = np.arange(len(ids))
    rows_ = sorted(zip(down.tolist(), key.tolist()))
    cuts = [rows_[i * len(rows_) // 10] for i in range(1, 10)]
    held = np.bincount(fp._range_of(down, key, tuple(np.array(c, np.int64) for c in zip(*cuts))))
    assert len(held) == 10 and held.max() <= 2 * np.median(held)
    got = {(r.doc_id, r.edited_sha256) for r in fp.fingerprints(docs_frame(spark, made)).collect() if r.doc_id is not None}
    want = expected([m[:2] for m in made if m[0] is not None and m[0] != -2**61])  # the smallest id is followed by some NULL one
    assert {(d, w[1]) for d, w in want.items() if d != 0} <= got


def test_long_texts_keep_their_counts():
    """A cell of a text of two million words counts far more pieces than 16 bits hold; the stored sketch has them all."""
    text = words(random.Random(4), 2_000_000, 50_000)
    digest, row = fp.pieces([text])
    table = fp.sketch(digest, row, 1)
    again = fp.Sketches.decoded(table.encoded())
    assert (again.count == table.count).all() and (again.keys == table.keys).all() and (again.checks == table.checks).all()
    assert table.count.max() > 2**15 and table.count.sum() == 3 * len(digest)
