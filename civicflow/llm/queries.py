"""The contract queries: thin wrappers that read whole tables and apply the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.llm.common import table
from civicflow.llm.decontaminate import contamination
from civicflow.llm.fingerprints import fingerprints
from civicflow.llm.language_id import held_out, train, with_language
from civicflow.llm.mixing import mix
from civicflow.llm.ngram_join import near_duplicates
from civicflow.llm.secret_ledger import BASE, scan_history
from civicflow.llm.secret_ledger import spelled as named_spans
from civicflow.llm.sharding import place
from civicflow.llm.source_divergence import divergence
from civicflow.llm.substring_dedup import remove_repeats
from civicflow.llm.turn_repair import repair
from civicflow.llm.url_filter import blocked, canonical
from civicflow.llm.warc import read_archives, write_archives
from civicflow.llm.weak_pii import KINDS, find_spans, spelled


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that its text repeats."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard."""
    return place(table(spark, sf_dir, "documents").select("doc_id")).select("doc_id", "slot", "shard")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: base spans, and all spans with those that the classifier adds."""
    rows, _, _ = find_spans(table(spark, sf_dir, "documents"))
    n = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return (rows.withColumn("spans", F.expr("array_sort(concat(base, added))"))
            .select("doc_id", *n, F.sha2(spelled("base"), 256).alias("base_sha256"), spelled("spans").alias("spans"),
                    F.size("added").cast("long").alias("n_added"), F.size("spans").cast("long").alias("n_spans")))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language; two thirds of the ids are there to learn from."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    found = with_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                        F.col("share").alias("position_share"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set size and near-duplicate component."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from dictionary-compressed archives."""
    manifest = write_archives(table(spark, sf_dir, "pages"))
    return read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's sketch, its edited text's, and how alike they are."""
    return fingerprints(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict.  The canonical URLs of pages whose id is divisible by 100 stand for
    a list of blocked URLs; all pages are judged."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where("page_id % 100 = 0").select(canonical(F.col("url")).alias("url"))
    return blocked(pages, listed).select("page_id", "host", "path", "rule", "verdict", "listed")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that no earlier 20-word window covers."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the secrets in its text, each distinct text scanned once."""
    found = scan_history(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = tuple(r.kind for r in BASE)
    n = [F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *n, F.sha2(named_spans("spans", kinds), 256).alias("base_sha256"), named_spans("spans").alias("spans"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults, cheapest edits and repaired rows' digest."""
    return repair(table(spark, sf_dir, "conversations"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source's distance to the others of its language, and its ten most telling terms."""
    return divergence(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_mixing": op2_mixing,
        "op3_sharding": op3_sharding,
        "op4_pii": op4_pii,
        "op5_language_id": op5_language_id,
        "op6_ngram_join": op6_ngram_join,
        "op7_warc": op7_warc,
        "op8_fingerprints": op8_fingerprints,
        "op9_url_filter": op9_url_filter,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_secret_ledger": op11_secret_ledger,
        "op12_turn_repair": op12_turn_repair,
        "op13_source_divergence": op13_source_divergence,
    }
