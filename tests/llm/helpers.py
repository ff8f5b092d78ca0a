"""Small tables for the operator tests."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns whose names the operators use inside.
CLASH = ("key", "id", "size", "digest", "places", "row", "bucket", "order", "times", "letters", "slot", "n_words", "of")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_texts():
    """NULL, empty, blank, odd separators, one word, non-Latin, a long text, ties and repeats."""
    rng = random.Random(5)
    base = words(rng, 60)
    return [None, "", " \n\t", "word", "a b c d", "A B c d", "été Straße Ünï", "x y z", "..., !!!", base, base, base.upper(),
            base + " tail of other words", "head " + base, words(rng, 5000), words(rng, 400, 3), "日本語 テキスト です", "a" * 20000,
            "\x0b\x0c sep\x0barated\x0cwords\r\n", base[:200] + " " + words(rng, 30)]


def rows(texts, sources=("s1", "s2", None)):
    return [(i, t, ("en", "de", None)[i % 3], sources[i % len(sources)], len(t) if t is not None else None)
            for i, t in enumerate(texts)]


def docs_frame(spark, data=None, clash=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows(edge_texts()) if data is None else data, DOCS)
    for c in CLASH if clash else ():
        df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def sf(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def tuples(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=lambda t: tuple((v is None, v) for v in t))
