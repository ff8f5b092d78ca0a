"""A training corpus from ``documents``: five stages, each one of the operators in ``civicflow.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's result as Parquet in the shared scratch folder and hands it to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civicflow.llm.common import stored, table
from civicflow.llm.decontaminate import decontaminate
from civicflow.llm.language_id import keep_known, train
from civicflow.llm.mixing import mixed_documents
from civicflow.llm.ngram_join import one_of_each
from civicflow.llm.sharding import place


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trains the byte network on the labelled rows; documents without a letter or without a likely language go."""
    return keep_known(docs, train(docs.select("text", "lang")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or sampled, to their source's target."""
    return mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its slot and shard."""
    return place(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates),
          ("benchmark_decontamination", benchmark_decontamination), ("source_mix", source_mix), ("shards", shards)]

# A recurrent network isn't SQL; the stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
