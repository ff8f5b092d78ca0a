"""Near duplicates: exact Jaccard self-join of word n-gram sets by rare-first prefix filtering.

The set of a text is its distinct n-word shingles (fewer words than n: the whole
sequence as one).  Two texts link when intersection / union reaches the threshold.

Method
* Equal sets collapse to one digest first; copies never meet each other again.  Digests that two different sets
  have (a second digest tells) are replaced by the second one, so equal means equal.
* Every distinct n-gram hash is dealt to a hash bucket together with the digest
  of its set.  A mapper sends each set once per flush, however many copies it
  read.  A bucket counts in how many sets its n-grams occur.
* N-grams that one in HOT_SHARE sets holds, or more, never meet in a bucket: the first pass over
  the texts finds them (each is that frequent in some flush) with a count that serves as their
  frequency, and mappers send them straight on to their sets, which are spread evenly.  Any order that all sets
  agree on will do for rare-first, and that such an n-gram is shared is known.
* Rare-first order is (sets containing the n-gram, hash).  N-grams of a single set come
  first and can't match anything; a set whose shared n-grams are fewer than the
  overlap any partner needs is out before a pair exists.  The others index only
  the shared n-grams of their prefix: the first size - ceil(t * size) + 1.
* Candidates join on prefix n-grams and pass the length filter, the positional
  filter (n-grams left after the match) and the suffix filter (n-grams whose hash slot
  the other set leaves empty can't be shared).  Each candidate pair is verified once,
  by intersection; later rounds leave out the pairs of earlier ones.
* Groups are linked through a hub first: within each prefix n-gram every set is
  paired with the hub alone (a first round takes the set with the fewest unshared
  n-grams as hub, a second one by hash).  Only then are pairs formed, and only
  between sets that are still in different components, so a group of near copies
  costs as many pairs as it has members, and no link between components is lost.
  Links inside a component aren't all formed then; ``near_duplicate_links`` lists every link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicflow.llm.bytehash import LOWER, NOT_SPACE, gram_hashes, mix, range_hashes, word_ranges
from civicflow.llm.common import bucket_count, byte_view, slices, spread_join, stored
from civicflow.llm.components import connected_components

N_WORDS = 5
THRESHOLD = 75          # per cent
BUCKET_GRAMS = 1_000_000  # n-grams that one bucket gathers
FLUSH_GRAMS = 1_000_000   # n-grams that a mapper holds before it sends them on
SLOTS = 1024            # hash slots of the suffix filter
HOT_SHARE = 256         # one set in so many holds a hot n-gram
HUB_ROUNDS = 2


def shingle_sets(column: pa.Array, n: int = N_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct n-gram hashes, their row, set digest per row, second digest); rows in order, hashes sorted within a row."""
    data, off = byte_view(column)
    starts, ends, counts = word_ranges(data, off, NOT_SPACE)
    words = range_hashes(data, starts, ends, LOWER)
    h, row, _ = gram_hashes(words, counts, n)
    few = np.flatnonzero((counts > 0) & (counts < n))
    if len(few):
        first = np.cumsum(counts) - counts
        whole = np.array([np.bitwise_xor.reduce(mix(words[first[i]:first[i] + counts[i]] * np.uint64(2 * n + 1)
                                                    + np.arange(counts[i], dtype=np.uint64)))
                          for i in few], np.uint64)
        h = np.concatenate([h, mix(whole + counts[few].astype(np.uint64))])
        row = np.concatenate([row, few])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[keep], row[keep]
    sizes = np.bincount(row, minlength=len(counts))
    digests = [_digest(h, row, sizes, salt) for salt in DIGEST_SALTS]
    return h, row, *digests


DIGEST_SALTS = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def _digest(h: np.ndarray, row: np.ndarray, sizes: np.ndarray, salt: int) -> np.ndarray:
    """A digest of each row's set, 0 for an empty one: a sum of scrambled members, so their order doesn't matter."""
    total = np.zeros(len(sizes), np.uint64)
    np.add.at(total, row, mix(h ^ np.uint64(salt)))
    return np.where(sizes > 0, np.maximum(mix(total + sizes.astype(np.uint64)), 1), 0).astype(np.uint64)


def _told_apart(digest: np.ndarray, second: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Digests that different sets share, replaced by the second digest."""
    return np.where(np.isin(digest, shared), second, digest) if len(shared) else digest


def _sets_of_batches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """A row per text with its set's size and digests; a row per flush has the n-grams that are hot in it and their counts."""
    held: list[np.ndarray] = []
    seen: set[int] = set()  # copies count once, as in the sets that n-grams are counted by
    grams = 0

    def hot() -> Iterator[pa.RecordBatch]:
        if held:
            h, counts = np.unique(np.concatenate(held), return_counts=True)
            often = np.flatnonzero((counts > 1) & (counts * (2 * HOT_SHARE) >= len(seen)))
            held.clear()
            seen.clear()
            yield _sized([None], [None], [0], [0], [0], [h[often].view(np.int64).tolist()], [counts[often].tolist()])

    for batch in batches:
        for part in slices(batch, "text"):
            h, row, digest, second = shingle_sets(part.column("text"), n)
            yield _sized(part.column("doc_id"), part.column("key"), np.bincount(row, minlength=part.num_rows).astype(np.int64),
                         digest.view(np.int64), second.view(np.int64), None, None)
            held.append(h[_first_time(digest, seen)[row]])
            grams += len(held[-1])
            if grams >= FLUSH_GRAMS:
                yield from hot()
                grams = 0
    yield from hot()


def _first_time(digest: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which rows bring a set that is not in ``seen`` yet; it is then."""
    fresh = np.zeros(len(digest), bool)
    for i, d in enumerate(digest.tolist()):
        if d and d not in seen:
            seen.add(d)
            fresh[i] = True
    return fresh


SIZED = "doc_id bigint, key bigint, n_shingles bigint, digest bigint, second bigint, hot array<bigint>, counts array<bigint>"


def _sized(*columns) -> pa.RecordBatch:
    n = len(columns[0])
    types = (pa.int64(),) * 5 + (pa.list_(pa.int64()),) * 2
    return pa.RecordBatch.from_arrays([pa.nulls(n, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)],
                                      names=["doc_id", "key", "n_shingles", "digest", "second", "hot", "counts"])


def _deal(batches: Iterator[pa.RecordBatch], n: int, buckets: int, shared: np.ndarray, hot: np.ndarray, often: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Packs (bucket, digests, n-grams per digest, set sizes, n-grams), each set once per flush; hot n-grams
    go to their sets' buckets, with their frequency."""
    held: list[tuple[np.ndarray, ...]] = []
    seen: set[int] = set()
    grams = 0

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            h, owner, size = (np.concatenate([x[k] for x in held]) for k in range(3))
            held.clear()
            seen.clear()
            at = np.searchsorted(hot, h)
            known = hot[np.minimum(at, len(hot) - 1)] == h if len(hot) else np.zeros(len(h), bool)
            yield _pack(bucket_of(h[~known], buckets), owner[~known], size[~known], h[~known])
            if known.any():
                yield _pack(bucket_of(mix(owner[known]), buckets), owner[known], size[known], h[known], often[at[known]])

    for batch in batches:
        for part in slices(batch, "text"):
            h, row, digest, second = shingle_sets(part.column("text"), n)
            digest = _told_apart(digest, second, shared)
            mine = _first_time(digest, seen)[row]
            h, row = h[mine], row[mine]
            held.append((h, digest[row], np.bincount(row, minlength=part.num_rows)[row]))
            grams += len(h)
            if grams >= FLUSH_GRAMS:
                yield from flush()
                grams = 0
    yield from flush()


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the upper half of the hash, evenly."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


PACK = "bucket int, digests binary, runs binary, sizes binary, grams binary, freqs binary"
_PACK_NAMES = ["bucket", "digests", "runs", "sizes", "grams", "freqs"]
SETS = "digest bigint, size int, prefix int, grams array<bigint>, slots array<bigint>"


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin, and the end."""
    if not len(columns[0]):
        return np.zeros(1, np.int64)
    new = np.ones(len(columns[0]) + 1, bool)
    new[1:-1] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _pack(bucket: np.ndarray, owner: np.ndarray, size: np.ndarray, grams: np.ndarray, freq: np.ndarray | None = None) -> pa.RecordBatch:
    """One row per bucket: its n-grams set by set, with each set's digest and size once."""
    order = np.argsort(bucket, kind="stable")  # stays grouped by set within a bucket
    bucket, owner, size, grams = bucket[order], owner[order], size[order], grams[order]
    freq = None if freq is None else freq[order]
    rows, edge = [], _edges(bucket)
    for a, b in zip(edge[:-1], edge[1:]):
        runs = _edges(owner[a:b])
        first = a + runs[:-1]
        rows.append((int(bucket[a]), owner[first].tobytes(), np.diff(runs).astype(np.int32).tobytes(), size[first].astype(np.int32).tobytes(),
                     grams[a:b].tobytes(), None if freq is None else freq[a:b].astype(np.int32).tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32())] + [pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 6)], names=_PACK_NAMES)


def _unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(set digest, set size, n-gram, frequency) of each n-gram of a bucket."""
    out = ([], [], [], [])
    for d, r, s, g, f in zip(*(table.column(c) for c in _PACK_NAMES[1:])):
        runs = np.frombuffer(r.as_buffer(), np.int32)
        out[0].append(np.repeat(np.frombuffer(d.as_buffer(), np.uint64), runs))
        out[1].append(np.repeat(np.frombuffer(s.as_buffer(), np.int32), runs))
        out[2].append(np.frombuffer(g.as_buffer(), np.uint64))
        out[3].append(np.frombuffer(f.as_buffer(), np.int32) if f.is_valid else np.zeros(0, np.int32))
    return tuple(np.concatenate(x) for x in out)


def _shared(table: pa.Table, buckets: int) -> pa.Table:
    """One bucket of n-grams: those that two sets or more hold, with the number of sets, dealt by set.  Packs
    that have their frequencies are for sets already and pass."""
    ready = table.filter(pc.is_valid(table["freqs"]))
    table = table.filter(pc.is_null(table["freqs"]))
    if not len(table):
        return ready
    owner, size, grams, _ = _unpack(table)
    order = np.lexsort((owner, grams))
    owner, size, grams = owner[order], size[order], grams[order]
    first = _edges(grams, owner)[:-1]  # the same set may come from two flushes
    owner, size, grams = owner[first], size[first], grams[first]
    edge = _edges(grams)
    freq = np.repeat(np.diff(edge), np.diff(edge))
    mine = np.flatnonzero(freq > 1)
    mine = mine[np.argsort(owner[mine], kind="stable")]
    owner, size, grams, freq = owner[mine], size[mine], grams[mine], freq[mine]
    out = pa.Table.from_batches([_pack(bucket_of(mix(owner), buckets), owner, size, grams, freq)])
    return pa.concat_tables([ready.cast(out.schema), out]) if len(ready) else out


def _assemble(table: pa.Table, threshold: int) -> pa.Table:
    """One bucket of sets: each set that has enough shared n-grams for a partner, rare ones first."""
    owner, size, grams, freq = _unpack(table)
    order = np.lexsort((grams, freq, owner))
    order = order[_edges(owner[order], grams[order])[:-1]]  # hot n-grams come once per flush that has the set
    owner, size, grams = owner[order], size[order].astype(np.int64), grams[order]
    edge = _edges(owner)
    held, first = np.diff(edge), edge[:-1]
    need = -(-size[first] * threshold // 100)  # overlap that any partner needs
    stay = held >= need
    mine = np.repeat(stay, held)
    grams, held, first, need = grams[mine], held[stay], first[stay], need[stay]
    slots = np.zeros((len(held), SLOTS // 64), np.uint64)
    slot = (mix(grams) % np.uint64(SLOTS)).astype(np.int64)
    np.bitwise_or.at(slots, (np.repeat(np.arange(len(held)), held), slot >> 6), np.uint64(1) << (slot & 63).astype(np.uint64))
    lists = lambda v, n: pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(v.view(np.int64)))
    return pa.table({"digest": pa.array(owner[first].view(np.int64)), "size": pa.array(size[first].astype(np.int32)),
                     # N-grams of this set alone come first in rare-first order; the rest of its prefix are these:
                     "prefix": pa.array((held - need + 1).astype(np.int32)), "grams": lists(grams, held),
                     "slots": lists(slots.reshape(-1), np.full(len(held), SLOTS // 64))})


def _need(a, b, threshold: int):
    """Overlap that sets of these sizes need: 100 * o >= t * (a + b - o)."""
    return F.ceil((a + b) * F.lit(threshold) / F.lit(100.0 + threshold)).cast("int")


def _links(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of digests whose sets reach the threshold; each pair is verified once."""
    x = sets.select(F.col("digest").alias("a"), F.col("size").alias("size_a"), F.col("grams").alias("grams_a"))
    y = sets.select(F.col("digest").alias("b"), F.col("size").alias("size_b"), F.col("grams").alias("grams_b"))
    both = pairs.join(x, "a").join(y, "b")
    overlap = F.size(F.array_intersect("grams_a", "grams_b"))
    return (both.withColumn("overlap", overlap)
            .where(F.col("overlap") * (100 + threshold) >= (F.col("size_a") + F.col("size_b")) * threshold)
            .select("a", "b"))


def _filters(threshold: int):
    """Length and positional filters of a candidate pair that shares one prefix n-gram."""
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    most = F.least("before_a", "before_b") + 1 + F.least("after_a", "after_b")
    return (small * 100 >= large * threshold) & (most >= _need(F.col("size_a"), F.col("size_b"), threshold))


def _suffix_filter(threshold: int):
    """Each slot that only one set fills holds at least one n-gram that isn't shared."""
    only = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))),
                                    F.lit(0), lambda n, v: n + v)
    need = _need(F.col("size_a"), F.col("size_b"), threshold)
    held = lambda x: F.col(f"before_{x}") + 1 + F.col(f"after_{x}")
    return (held("a") - only("slots_a", "slots_b") >= need) & (held("b") - only("slots_b", "slots_a") >= need)


def _side(index: DataFrame, name: str) -> DataFrame:
    return index.select("gram", *[F.col(c).alias(f"{c}_{name}") for c in index.columns if c != "gram"])


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("digest_a", "digest_b").alias("a"), F.greatest("digest_a", "digest_b").alias("b")).distinct()


def _distinct_digests(rows: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(rows with a digest that different sets never share, the digests that were replaced).  At 64 bits a
    corpus of 10^11 texts has about a hundred of those."""
    lanes = rows.where("n_shingles > 0").groupBy("digest").agg(F.min("second").alias("a"), F.max("second").alias("b")).where("a != b")
    shared = np.array(sorted(r.digest for r in lanes.select("digest").collect()), np.int64)
    if len(shared):
        own = F.col("digest").isin([int(d) for d in shared])
        rows = rows.withColumn("digest", F.when(own, F.col("second")).otherwise(F.col("digest")))
    return rows.drop("second"), shared.view(np.uint64)


def _hot_grams(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, sorted; their frequencies): all that one set in HOT_SHARE holds, and at most 2 * HOT_SHARE times the mean size
    of a set.  An n-gram that frequent is so in some flush, and the flushes where it is half as frequent hold half of its sets."""
    each = found.where("hot is not null").select(F.explode(F.arrays_zip("hot", "counts")).alias("g")).groupBy("g.hot").agg(F.sum("g.counts").alias("n"))
    sets = found.where("n_shingles > 0").select(F.approx_count_distinct("digest")).first()[0]
    rows = each.where(F.col("n") * 2 * HOT_SHARE >= sets).where("n > 1").collect()
    grams = np.array([r.hot for r in rows], np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], np.array([r.n for r in rows], np.int64)[order]


def text_key():
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("key")


def _indexed(docs: DataFrame, n: int, threshold: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, sets, index): documents as ``ngram_links`` gives them, sets that have enough shared n-grams
    for a partner, and a row per prefix n-gram of each."""
    spark = docs.sparkSession
    slim = docs.select("doc_id", text_key(), "text")
    found = stored(slim.mapInArrow(lambda it: _sets_of_batches(it, n), SIZED), "shingle-sizes")
    sizes, shared_digests = _distinct_digests(found.where("hot is null").drop("hot", "counts"))
    hot, often = _hot_grams(found)
    total = found.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = bucket_count(total, BUCKET_GRAMS, spark)
    packs = docs.select("text").mapInArrow(lambda it: _deal(it, n, buckets, shared_digests, hot, often), PACK)
    shared = packs.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(lambda t: _shared(t, buckets), PACK)
    sets = stored(shared.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(lambda t: _assemble(t, threshold), SETS),
                  "shingle-sets")
    index = (sets.select("digest", "size", F.size("grams").alias("held"), F.posexplode(F.slice("grams", F.lit(1), F.col("prefix"))))
             .select(F.col("col").alias("gram"), "digest", "size", F.col("pos").alias("before"), (F.col("held") - F.col("pos") - 1).alias("after")))
    return sizes, sets, index


def ngram_links(docs: DataFrame, n: int = N_WORDS, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(documents, components): documents has doc_id, key (hash of the text), n_shingles, digest for every row;
    components has digest, component (the smallest digest that links reach) for digests with a link."""
    sizes, sets, index = _indexed(docs, n, threshold)
    links = asked = None
    for i in range(HUB_ROUNDS):
        unshared = F.lit(1.0) - (F.col("before") + F.col("after") + 1) / F.col("size")
        order = F.struct(unshared if i == 0 else F.xxhash64("digest", F.lit(i)), F.col("digest"))
        hubs = index.groupBy("gram").agg(F.min_by(F.struct("digest", "size", "before", "after"), order).alias("hub"), F.count("*").alias("members"))
        b = _side(hubs.where("members > 1").select("gram", "hub.*"), "b")
        pairs = _pairs(_side(index, "a").join(b, "gram").where((F.col("digest_a") != F.col("digest_b")) & _filters(threshold)))
        pairs = stored(pairs if asked is None else pairs.join(asked, ["a", "b"], "left_anti"), "shingle-pairs")
        asked = pairs if asked is None else asked.unionByName(pairs)
        found = stored(_links(pairs, sets, threshold), "shingle-links")
        links = found if links is None else links.unionByName(found)
    comps = connected_components(links)
    # What the hubs didn't join: pairs between different components.  Rows of an n-gram's
    # largest component meet the others, but never each other.
    tagged = stored(index.join(comps.withColumnRenamed("node", "digest"), "digest", "left")
                    .withColumn("comp", F.coalesce("component", "digest")).drop("component"), "shingle-index")
    per_comp = tagged.groupBy("gram", "comp").agg(F.count("*").alias("members"))
    mixed = (per_comp.groupBy("gram").agg(F.max(F.struct("members", "comp")).alias("top"), F.count("*").alias("comps"))
             .where(F.col("comps") > 1).select("gram", F.col("top.comp").alias("largest")))
    rest = stored(tagged.join(mixed, "gram").join(sets.select("digest", "slots"), "digest"), "shingle-mixed")
    outside = _side(rest.where(F.col("comp") != F.col("largest")).drop("largest"), "a")
    pairs = _pairs(outside.join(_side(rest.drop("largest"), "b"), "gram")
                   .where((F.col("comp_a") != F.col("comp_b")) & _filters(threshold) & _suffix_filter(threshold))).join(asked, ["a", "b"], "left_anti")
    more = stored(_links(pairs, sets, threshold), "shingle-links")
    if not more.isEmpty():
        comps = connected_components(links.unionByName(more))
    return sizes, comps


def near_duplicate_links(docs: DataFrame, n: int = N_WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """Every link between different sets, once: a, b (digests, a < b), id_a, id_b, rows_a, rows_b.

    The ids are the smallest doc_id of the rows with that set (NULL if none has one), rows_a and rows_b their
    numbers, so rows_a * rows_b pairs of rows link; rows of one set are copies and not listed.  All pairs that
    share a prefix n-gram and pass the filters are verified, without hubs and components: a group of near
    copies gives as many rows as it has links, up to the square of its size.  NULL, empty and blank texts
    link with nothing; other columns are ignored; an empty table gives no rows.
    """
    sizes, sets, index = _indexed(docs, n, threshold)
    slotted = index.join(sets.select("digest", "slots"), "digest")
    pairs = _pairs(_side(slotted, "a").join(_side(slotted, "b"), "gram")
                   .where((F.col("digest_a") < F.col("digest_b")) & _filters(threshold) & _suffix_filter(threshold)))
    links = stored(_links(pairs, sets, threshold), "shingle-links")
    heads = stored(sizes.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("id"), F.count("*").alias("rows")), "shingle-heads")
    head = lambda x: heads.select(F.col("digest").alias(x), F.col("id").alias(f"id_{x}"), F.col("rows").alias(f"rows_{x}"))
    return links.join(head("a"), "a").join(head("b"), "b").select("a", "b", "id_a", "id_b", "rows_a", "rows_b")


def near_duplicates(docs: DataFrame, n: int = N_WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest doc_id that links reach, itself included.
    NULL, empty and blank texts have an empty set and stay alone.  Repeated rows
    are copies and share a component.  A NULL doc_id belongs to its text's
    component but never names it (unless no member has an id: NULL).  Other columns
    of ``docs`` are ignored.  An empty table gives no rows.
    """
    sizes, comps = ngram_links(docs, n, threshold)
    heads = stored(sizes.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("head"))
                   .join(comps.withColumnRenamed("node", "digest"), "digest", "left"), "shingle-heads")
    linked = stored(heads.where("component is not null").select("digest", "component", "head"), "shingle-linked")
    per_comp = linked.groupBy("component").agg(F.min("head").alias("component_id"))
    named = stored(spread_join(linked, per_comp, "component").select("digest", "component_id")
                   .unionByName(heads.where("component is null").select("digest", F.col("head").alias("component_id"))), "shingle-names")
    return (spread_join(sizes, named, "digest", "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, n: int = N_WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each component, all columns; of a component's rows the one with the
    smallest doc_id stays (NULL last; equal ids by a hash of the text; of wholly equal rows any one).

    Texts without words are linked with nothing and all stay.  An empty table gives no rows.
    """
    sizes, comps = ngram_links(docs, n, threshold)
    member = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    heads = (sizes.where("n_shingles > 0").groupBy("digest").agg(F.min(member).alias("head"))
             .join(comps.withColumnRenamed("node", "digest"), "digest", "left")
             .groupBy(F.coalesce("component", "digest")).agg(F.min("head").alias("head")))
    # NULL ids are told apart from 0, so rows and heads meet by plain equality.
    ident = lambda d, k: [F.coalesce(d, F.lit(0)).alias("own_id"), d.isNull().alias("no_id"), k.alias("own_key")]
    by = ["own_id", "no_id", "own_key"]
    stay = stored(heads.select(*ident(F.col("head.doc_id"), F.col("head.key"))), "shingle-stay")
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    rows = docs.select(F.struct("*").alias("row"), has_words.alias("has_words"), *ident(F.col("doc_id"), text_key()))
    # Of equal rows one per task is left before anything is shuffled (a limit of one within each window); texts
    # without words never meet.
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(1)))
    once = rows.where("has_words").withColumn("nth", nth).where("nth = 1")
    return once.join(stay, by, "left_semi").select("row.*").unionByName(rows.where("not has_words").select("row.*"))
