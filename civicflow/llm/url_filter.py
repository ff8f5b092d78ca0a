"""URL filter: rules first, then a list of blocked URLs behind a blocked Bloom filter.

A listed URL sets eight bits, one in each 32-bit lane of a block that its hash picks.  The
filter is a table of blocks built by one aggregate (bit_or per lane).  A URL whose eight
bits are all set is a possible hit; only possible hits go to the exact join with the list,
which removes the false positives.  Both joins are left to the planner: a short list's
blocks are broadcast by their measured size, a long one's are joined by block number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import stored

LANES = 8
BITS_PER_URL = 16
# (host, path, verdict); a rule fits its host and its subdomains, and paths that start with its path
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Odd multipliers, one per lane, that pick a bit from the hash.
SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without leading www. or m., path without a trailing slash or .html; scheme, query and fragment go."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    return F.concat(host, F.regexp_replace(path_of(url), r"(/|\.html)$", ""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, or NULLs."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _bit(h: Column, lane: int) -> Column:
    """Bit 0 to 31 of a lane: the top five of the low 31 hash bits times the lane's multiplier."""
    product = h.bitwiseAND(F.lit(0x7FFFFFFF)) * F.lit(SALTS[lane])
    return F.shiftright(product, 27).bitwiseAND(F.lit(31)).cast("int")


def _block(h: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h, 32), F.lit(blocks))


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """One row per block that is used: block, lane_0 to lane_7.  ``listed`` has a column url."""
    h = F.xxhash64("url")
    rows = listed.select(_block(h, blocks).alias("block"),
                         *[F.call_function("shiftleft", F.lit(1).cast("long"), _bit(h, i)).alias(f"bit_{i}") for i in range(LANES)])
    return rows.groupBy("block").agg(*[F.bit_or(f"bit_{i}").alias(f"lane_{i}") for i in range(LANES)])


def blocked(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, possible, listed.

    ``listed`` has a column url of canonical URLs.  A rule's verdict stands; without a rule a listed
    URL is blocked, any other allowed.  A NULL URL, or one without ://, has empty host and path and is
    never listed; NULL and empty list entries are ignored, repeated ones count once.  Other columns
    are ignored.  Empty tables: no rows, or nothing listed.
    """
    urls = stored(listed.where("url is not null and url != ''").select("url").distinct(), "url-list")
    blocks = max(1, urls.count() * BITS_PER_URL // (32 * LANES))
    cells = stored(bloom(urls, blocks), "url-bloom")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    h = F.xxhash64("key")
    rows = (pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"), canonical(F.col("url")).alias("key"))
            .withColumn("rule", rule).withColumn("ruled", verdict).withColumn("block", _block(h, blocks)))
    set_bits = [F.getbit(F.col(f"lane_{i}"), _bit(h, i)) == 1 for i in range(LANES)]
    all_set = set_bits[0]
    for b in set_bits[1:]:
        all_set = all_set & b
    probed = (rows.join(cells, "block", "left")
              .withColumn("possible", F.coalesce(all_set, F.lit(False)) & (F.col("key") != "")))
    # Written once, as both halves read it; only possible hits shuffle.
    probed = stored(probed.select("page_id", "host", "path", "key", "rule", "ruled", "possible"), "url-probed")
    out = ["page_id", "host", "path", "rule", "ruled", "possible"]
    passed = probed.where(~F.col("possible")).select(*out, F.lit(False).alias("listed"))
    hits = (probed.where("possible").join(urls.withColumnRenamed("url", "hit"), F.col("key") == F.col("hit"), "left")
            .select(*out, F.col("hit").isNotNull().alias("listed")))
    verdict = F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow"))
    return passed.unionByName(hits).withColumn("verdict", verdict).drop("ruled")
