"""Secret scans over history: an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text.  The ledger holds, for each blob ever
scanned, the rules with their versions and what they found.  A scan looks only at pairs of
blob and rule version that it does not hold yet: copies, reverted texts and moved files cost a digest, and a
new or changed rule is run alone.  Findings go back to all paths and versions by a join on the digest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import spread_join, stored
from civicflow.llm.weak_pii import matches, placed
from civicflow.session import scratch_path
from civicflow.sources.tables import folder_names


def _either(word: str) -> str:
    """ASCII letters in either case, without any engine's own folding."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = f"({_KEYWORDS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
_ASSIGN_SQL = "'" + _ASSIGN.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost non-overlapping matches count where ``check`` (SQL over x.value) holds;
    ``condition`` is cheap SQL over text that every match fulfils."""

    kind: str
    version: int
    pattern: str
    condition: str
    check: str = "true"


BASE = (
    Rule("assign", 1, _ASSIGN, f"text rlike '{_KEYWORDS}'", f"length(regexp_extract(x.value, {_ASSIGN_SQL}, 2)) >= 12"),
    Rule("access", 1, "AKIA[A-Z0-9]++", "contains(text, 'AKIA')", "length(x.value) >= 18"),
    # Runs of hexadecimal digits are maximal and don't overlap, so short ones may be left out of the pattern.
    Rule("hex", 1, "(?<![0-9a-f])[0-9a-f]{16,}+", "text rlike '[0-9a-f]{16}'"),
)
# Formats whose leading text alone tells them.
ADDED = (
    Rule("github", 1, "gh[oprsu]_[A-Za-z0-9]{36,}+", r"text rlike 'gh[oprsu]_'"),
    Rule("jwt", 1, "eyJ[A-Za-z0-9_-]++\\.eyJ[A-Za-z0-9_-]++\\.[A-Za-z0-9_-]++", "contains(text, 'eyJ')"),
    Rule("pem", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----", "contains(text, 'PRIVATE KEY-----')"),
    Rule("login", 1, "[a-z][a-z0-9+.-]*+://[A-Za-z0-9._~%-]++:[^\\x00-\\x20\"'/@]{3,}+@", "contains(text, '://')"),
)
RULES = BASE + ADDED
# New blobs of one scan whose digests are broadcast (about 20 MB); beyond it the texts are grouped by digest first.
BROADCAST_BLOBS = 200_000
_SPANS = "array<struct<start:int,end:int>>"
_LEDGER = f"blob string, scanned array<struct<kind:string,version:int,spans:{_SPANS}>>"


class Ledger:
    """Scans on a shared folder, one folder of Parquet files per scan.  A scan that did not finish left no
    ``_SUCCESS`` and is not read; repeating it writes a new folder."""

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root

    def scans(self) -> list[str]:
        """Folders of the finished scans."""
        return [path for n in folder_names(self.spark, self.root) if "_SUCCESS" in folder_names(self.spark, path := f"{self.root}/{n}")]

    def rows(self) -> DataFrame:
        """(blob, scanned); a blob has a row for each scan that looked at it."""
        found = self.scans()
        return self.spark.read.schema(_LEDGER).parquet(*found) if found else self.spark.createDataFrame([], _LEDGER)

    def append(self, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.root}/scan={len(folder_names(self.spark, self.root)):06d}")


def blob_id() -> Column:
    return F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)


def _unseen(addressed: DataFrame, ledger: Ledger, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, due): the kinds of rules that have not seen the blob in their present version."""
    blobs = addressed.select("blob").distinct()
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    if not ledger.scans():
        return blobs.withColumn("due", F.transform(wanted, lambda w: w["kind"]))
    seen = ledger.rows().select("blob", F.explode("scanned").alias("s")).select("blob", "s.kind", "s.version")
    pairs = blobs.select("blob", F.explode(wanted).alias("w")).select("blob", "w.kind", "w.version")
    return pairs.join(seen, ["blob", "kind", "version"], "left_anti").groupBy("blob").agg(F.collect_set("kind").alias("due"))


def _spans(rule: Rule) -> Column:
    """The rule's spans in a text as (start, end) in code points, end exclusive."""
    return F.expr(f"transform(filter(at_{rule.kind}, x -> {rule.check}), x -> struct(x.start as start, x.end as end))")


def scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, text, due) -> (blob, scanned): each rule that is due, with its spans."""
    found = texts.select("blob", "due", *[matches(r.pattern, f"array_contains(due, '{r.kind}') and {r.condition}").alias(f"hits_{r.kind}") for r in rules])
    at = found.select("blob", "due", *[placed(f"hits_{r.kind}").alias(f"at_{r.kind}") for r in rules])
    each = F.array(*[F.when(F.array_contains("due", r.kind), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), _spans(r).alias("spans")))
                     for r in rules])
    return at.select("blob", F.filter(each, lambda s: s.isNotNull()).alias("scanned"))


def update(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> int:
    """Scan what the ledger has not seen of ``versions`` (a row per version of a path, with its text), record it, and
    return the number of blobs scanned."""
    addressed = versions.select(blob_id().alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    due = stored(_unseen(addressed, ledger, rules), "ledger-due")
    new = due.count()
    if not new:
        return 0
    one = lambda rows: rows.groupBy("blob").agg(F.first("text").alias("text"))  # noqa: E731  (equal blobs have equal texts)
    if new <= BROADCAST_BLOBS:
        texts = one(addressed.join(F.broadcast(due.select("blob")), "blob", "left_semi")).join(due, "blob")
    else:
        texts = one(addressed).join(due, "blob")
    ledger.append(scan(texts, rules))
    return new


def findings(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` without text, with blob and spans: array of (start, rank, end, kind) in order, by the present rules.

    NULL text is empty; equal texts get equal spans; NULL and repeated ids and other columns are carried
    through, but for columns named text, blob and spans; an empty table gives no rows.
    """
    rank = F.create_map(*[v for i, r in enumerate(rules) for v in (F.lit(f"{r.kind}:{r.version}"), F.lit(i))])
    each = ledger.rows().select("blob", F.explode("scanned").alias("s")).select(
        "blob", "s.kind", rank[F.concat_ws(":", "s.kind", "s.version")].alias("rank"), F.explode("s.spans").alias("at")).where("rank is not null")
    spans = each.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("at.start", "rank", "at.end", "kind"))).alias("spans"))
    rows = stored(versions.withColumn("blob", blob_id()).drop("text", "spans"), "ledger-versions")
    return spread_join(rows, spans, "blob", "left").withColumn("spans", F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string>>)")))


def scan_history(versions: DataFrame, rules: tuple[Rule, ...] = RULES, root: str | None = None) -> DataFrame:
    """Update the ledger under ``root`` (a new one if None) with ``versions`` and give each version its findings."""
    spark = versions.sparkSession
    ledger = Ledger(spark, root or scratch_path(spark, "secret-ledger"))
    update(versions, ledger, rules)
    return findings(versions, ledger, rules)


def spelled(spans: str, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end, comma-joined; of some kinds or all."""
    picked = spans if kinds is None else f"filter({spans}, x -> x.kind in ({', '.join(repr(k) for k in kinds)}))"
    return F.expr(f"array_join(transform({picked}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")
