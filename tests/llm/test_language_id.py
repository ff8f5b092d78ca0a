import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civicflow.llm import language_id as lid
from tests.llm.helpers import DOCS, docs_frame, edge_texts, rows


def test_backpropagation_matches_finite_differences():
    rng = np.random.default_rng(0)
    model = lid.ByteGRU(["a", "b", "c"], hidden=4)
    for k in model.w:
        model.w[k] = model.w[k].astype(np.float64)
    x, label = rng.integers(97, 101, (6, 5)), np.array([0, 1, 2, 1, 0])
    mask = np.arange(6)[:, None] < np.array([6, 4, 1, 5, 6])[None, :]

    def loss():
        p = model.probabilities(x)
        return float(-(np.log(p[:, label, np.arange(5)]) * mask).sum() / mask.sum())

    grad = model.gradient(x, label, mask)
    for k, g in grad.items():
        flat, step = model.w[k].reshape(-1), 1e-2
        for i in np.argsort(-np.abs(g.reshape(-1)))[:3]:
            old = flat[i]
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert g.reshape(-1)[i] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=1e-4), k


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lid.train(docs.where(~lid.held_out(F.col("doc_id"))).select("text", "lang"))
    test = docs.where(lid.held_out(F.col("doc_id")))
    got = {r.doc_id: r for r in lid.with_language(test, model).collect()}
    truth = {r.doc_id: r.lang for r in test.collect()}
    assert np.mean([got[d].lang_pred == lang for d, lang in truth.items()]) > 0.97
    assert all(0 <= r.score <= 1 and 0 <= r.share <= 1 for r in got.values())
    kept = lid.keep_known(docs, model)
    assert kept.columns == docs.columns and kept.count() > 0.99 * docs.count()


def model():
    texts = ["aab aba abba baab " * 3, "xyx yxy xxyy yyx " * 3]
    windows = np.full((2, lid.WINDOW), 32, np.uint8)
    for i, t in enumerate(texts):
        b = t.encode()[:lid.WINDOW]
        windows[i, :len(b)] = np.frombuffer(b, np.uint8)
    return lid.ByteGRU(["ab", "xy"]).fit(windows, np.array([54, 51]), np.array([0, 1]), steps=30)


def test_edge_texts(spark):
    df = docs_frame(spark, clash=True)
    got = {r.doc_id: r for r in lid.with_language(df, model()).collect()}
    for i, t in enumerate(edge_texts()):
        letters = t is not None and any(c.isalpha() for c in t)
        assert (got[i].lang_pred == lid.UNKNOWN) == (not letters)
        assert 0 <= got[i].score <= 1
    kept = lid.keep_known(df, model())
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.lang_pred != lid.UNKNOWN and r.score >= 0.3}


def test_a_text_is_read_whole_and_alone():
    m = model()
    texts = ["ab " * 5, "xy " * 9000, "", None, "abba", "xy " * 9000]
    yes = pa.array([True] * len(texts))
    lang, score, share = lid.classify(m, pa.array(texts, pa.string()), yes)
    for i, t in enumerate(texts):
        one = lid.classify(m, pa.array([t], pa.string()), yes[:1])
        assert one[0][0] == lang[i] and one[1][0].as_py() == pytest.approx(score[i].as_py(), abs=1e-5)
    data = pa.array(["ab" * 400 + "xy" * 6000])
    assert lid.classify(m, data, yes[:1])[0][0].as_py() == "xy"  # the end counts


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], DOCS)
    assert lid.train(empty.select("text", "lang")) is None
    unlabelled = docs_frame(spark, [(i, t, None, s, n) for i, t, _, s, n in rows(edge_texts())])
    assert lid.train(unlabelled.select("text", "lang")) is None
    assert {r.lang_pred for r in lid.with_language(unlabelled, None).collect()} == {lid.UNKNOWN}
    assert lid.with_language(empty, model()).collect() == [] and lid.keep_known(empty, model()).collect() == []
    assert lid.keep_known(unlabelled, None).count() == sum(t is not None and any(c.isalpha() for c in t) for t in edge_texts())


def test_copies_take_no_text_out_of_the_sample(spark):
    copied = {f"c{k}": f"one text of c{k} again and again" for k in range(4)}
    few = [("c0", f"text {i} of a few") for i in range(300)]
    df = spark.createDataFrame(few + [("plain", f"plain text {i}") for i in range(40)], "lang string, text string")
    for lang, text in copied.items():
        df = df.unionByName(spark.range(100_000).select(F.lit(lang).alias("lang"), F.lit(text).alias("text")))
    langs, _, lengths, label = lid.sample_windows(df)
    assert langs == [*copied, "plain"] and len(lengths) == len(label)
    texts = np.bincount(label) / lid.WINDOWS_PER_DOC
    assert texts.tolist() == [250, 1, 1, 1, 40]


def test_the_sample_does_not_depend_on_the_estimate(spark, monkeypatch):
    df = spark.createDataFrame([(f"l{i % 2}", f"text number {i}") for i in range(3000)], "lang string, text string")
    whole = lid.sample_windows(df, 50)
    monkeypatch.setattr(lid, "OVERSAMPLE", 0.001)
    again = lid.sample_windows(df, 50)
    assert whole[0] == again[0] and all((a == b).all() for a, b in zip(whole[1:], again[1:]))
    assert len(whole[3]) == 2 * 50 * lid.WINDOWS_PER_DOC


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "ab ab abba"), (1, "ab ab abba"), (None, "ab ab abba"), (None, None), (2, "")], "doc_id bigint, text string")
    got = sorted((str(r.doc_id), r.lang_pred, r.score) for r in lid.with_language(df, model()).collect())
    assert [g[:2] for g in got] == [("1", "ab"), ("1", "ab"), ("2", lid.UNKNOWN), ("None", "ab"), ("None", lid.UNKNOWN)]
    assert len({g[2] for g in got if g[1] == "ab"}) == 1
    assert lid.keep_known(df, model()).count() == 3
