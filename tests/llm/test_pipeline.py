from collections import Counter

import corpus_pipeline
from civicflow.llm.common import table
from civicflow.llm.language_id import has_letter
from civicflow.llm.sharding import fill, walk  # noqa: F401
from pyspark.sql import functions as F
from tests.llm import brute
from tests.llm.helpers import DOCS, SF, docs_frame


def test_stages_against_brute_force(spark):
    """Every stage on what its predecessor kept."""
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = docs
        rows, old = docs.collect(), before.collect()
        if name != "shards":
            assert docs.columns == columns
        if name == "language_id":
            assert {r.doc_id for r in rows} <= {r.doc_id for r in before.where(has_letter(F.col("text"))).collect()}
            assert len(rows) >= 0.99 * len(old) and set(rows) <= set(old)
        elif name == "near_duplicates":
            assert {r.doc_id for r in rows} == {d for d, _, c in brute.near_duplicates([(r.doc_id, r.text) for r in old]) if d == c}
            assert set(rows) <= set(old)
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
            hit = {d for d, *_, bad in brute.contamination([(r.doc_id, r.text) for r in old], items) if bad}
            assert not any(bad for *_, bad in brute.contamination([(r.doc_id, r.text) for r in rows], items))
            assert {r for r in rows if r.doc_id not in hit} == {r for r in old if r.doc_id not in hit}
        elif name == "source_mix":
            sizes = Counter()
            for r in old:
                sizes[r.source] += len(brute.SPACE_WORD.findall(r.text or ""))
            got, want = Counter(), brute.targets(dict(sizes))
            for r in rows:
                got[r.source] += len(brute.SPACE_WORD.findall(r.text or ""))
            largest = max(len(brute.SPACE_WORD.findall(r.text or "")) for r in old)
            assert all(abs(got[s] - want[s]) <= largest / 2 + 1 for s in sizes)
            assert max(Counter(r.doc_id for r in rows).values()) <= 3 and set(rows) <= set(old)
        else:
            names = fill()
            assert len(rows) == len(old) and all(names[r.slot] == r.shard for r in rows)


def test_run_and_edges(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100
    for made in ([], None):
        docs = docs_frame(spark, made, clash=True) if made is None else spark.createDataFrame(made, DOCS)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert (docs.count() > 0) == (made is None)
