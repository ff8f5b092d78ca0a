"""Source divergence by chunk factorization: how far apart a language's sources are, term by term.

A text is cut at white space only, and its chunks are counted per document.  Chunks repeat far more
than texts do, so the tokeniser runs once on each globally distinct chunk: mappers count the chunks of
their documents by hash, whole arrays at a time, and deal each distinct chunk once per flush, with its counts by
language and source, to a bucket.  A bucket has all there is of its chunks; it cuts each into terms,
which take over its counts.

Occurrences of a term are sums over its chunks.  Distinct documents aren't, as a document may hold
a term in several chunks ("cat", "cat."), but they lie between the largest chunk's documents and the sum.
Where both are on one side of the least number of documents, that decides; a term in between has
only chunks of fewer documents than that, whose rows travel with them and are counted one by one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicflow.llm.bytehash import NOT_SPACE, range_hashes, word_ranges
from civicflow.llm.common import bucket_count, byte_view, slices, stored, text_bytes

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
MIN_DOCS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000
FLUSH_WORDS = 800_000         # words that a mapper counts before it sends them on
BUCKET_BYTES = 24 << 20       # text whose chunks one bucket gathers
SOURCES_PER_BLOCK = 128       # sources compared with one another in one group
TERMS_PER_TILE = 2048
ENTRIES_PER_BUCKET = 50_000   # counts in one group, but no fewer than it gives sums


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin, and the end."""
    if not len(columns[0]):
        return np.zeros(1, np.int64)
    new = np.ones(len(columns[0]) + 1, bool)
    new[1:-1] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, edges[:-1]) if len(edges) > 1 else np.zeros(0, values.dtype)


def _within(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of runs that begin at ``first`` and have ``size`` elements, run after run."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


# ---- chunks of documents


class _Flush:
    """The words of some documents: hashes, document, and where their bytes are."""

    def __init__(self):
        self.words, self.data, self.bytes, self.groups, self.n = [], [], 0, [], 0

    def add(self, part: pa.RecordBatch) -> None:
        data, off = byte_view(part.column("text"))
        starts, ends, counts = word_ranges(data, off, NOT_SPACE)
        doc = np.repeat(np.arange(part.num_rows) + len(self.groups), counts)
        hashes = [range_hashes(data, starts, ends, seed=s) for s in (0, 1)]
        self.words.append((*hashes, doc, starts + self.bytes, (ends - starts).astype(np.uint32)))
        self.data.append(data)
        self.bytes += len(data)
        self.groups += zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
        self.n += len(doc)

    def packs(self, first_doc: int, task: int, buckets: int, min_docs: int) -> Iterator[tuple]:
        h, second, doc, start, size = (np.concatenate([w[k] for w in self.words]) for k in range(5))
        names = sorted(set(self.groups))
        number = {g: i for i, g in enumerate(names)}
        group = np.array([number[g] for g in self.groups], np.int64)
        langs = np.unique([lang for lang, _ in names], return_inverse=True)[1] if names else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        if ((h[order][1:] == h[order][:-1]) & (second[order][1:] != second[order][:-1])).any():  # two chunks of one hash
            order = np.lexsort((doc, second, h))
        h, second, doc = h[order], second[order], doc[order]
        chunk_at = _edges(h, second)
        pair_at = _edges(h, second, doc)
        pair_doc, pair_chunk = doc[pair_at[:-1]], np.searchsorted(chunk_at, pair_at[:-1], "right") - 1
        key = pair_chunk * max(1, len(names)) + group[pair_doc]
        by_entry = np.argsort(key, kind="stable")
        key = key[by_entry]
        entry_at = _edges(key)
        chunk, of = np.divmod(key[entry_at[:-1]], max(1, len(names)))
        n, docs = _sums(np.diff(pair_at)[by_entry], entry_at), np.diff(entry_at)
        lang_at = _edges(chunk, langs[of])
        few = np.repeat(_sums(docs, lang_at) < min_docs, np.diff(lang_at))
        listed = np.where(few, docs, 0)
        seen = (pair_doc[by_entry] + first_doc)[np.repeat(few, docs)]
        first = order[chunk_at[:-1]]
        start, size = start[first], size[first]
        data = np.concatenate(self.data)
        per_chunk = np.diff(np.searchsorted(chunk, np.arange(len(first) + 1)))
        bucket = ((h[chunk_at[:-1]] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        ends = [np.concatenate([[0], np.cumsum(x)]) for x in (per_chunk, listed)]
        cut = _edges(bucket)  # the hash's upper half is the bucket, so chunks lie in bucket order
        for a, b in zip(cut[:-1], cut[1:]):
            x, y = ends[0][[a, b]]
            u, v = ends[1][[x, y]]
            columns = (size[a:b], per_chunk[a:b], of[x:y], docs[x:y], listed[x:y], seen[u:v])
            packed = squeeze(b"".join([np.array([b - a, y - x, v - u], "<i8").tobytes(), n[x:y].astype("<i8").tobytes(),
                                       *[c.astype("<u4").tobytes() for c in columns], data[_within(start[a:b], size[a:b].astype(np.int64))].tobytes()]))
            yield int(bucket[a]), task, [lang for lang, _ in names], [s for _, s in names], packed


_PACK = pa.schema([("bucket", pa.int32()), ("task", pa.int64()), ("langs", pa.list_(pa.string())), ("sources", pa.list_(pa.string())), ("packed", pa.binary())])
_PACK_DDL = "bucket int, task long, langs array<string>, sources array<string>, packed binary"
_TERMS_DDL = "lang string, term string, docs long, seen array<long>, sources array<string>, ns array<long>"


def _count_chunks(batches: Iterator[pa.RecordBatch], buckets: int, min_docs: int, flush_words: int) -> Iterator[pa.RecordBatch]:
    task, done, held = TaskContext.get().partitionId(), 0, _Flush()

    def send() -> Iterator[pa.RecordBatch]:
        rows = list(held.packs(done, task, buckets, min_docs)) if held.n else []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PACK)], schema=_PACK)

    for batch in batches:
        for part in slices(batch, "text"):
            held.add(part)
            if held.n >= flush_words:
                yield from send()
                done, held = done + len(held.groups), _Flush()
    yield from send()


class _Unpacked:
    """All packs of a bucket as arrays: distinct chunks, and an entry for each pack, chunk, language and source."""

    def __init__(self, table: pa.Table):
        chunks, code, group, n, docs, listed, seen = [], [], [], [], [], [], []
        self.names: list[tuple[str, str]] = sorted({g for a, b in zip(table["langs"].to_pylist(), table["sources"].to_pylist()) for g in zip(a, b)})
        number = {g: i for i, g in enumerate(self.names)}
        open_up, at = zstandard.ZstdDecompressor().decompress, 0
        for task, langs, sources, packed in zip(*(table[c].to_pylist() for c in ("task", "langs", "sources", "packed"))):
            raw = open_up(packed)
            n_chunks, n_entries, n_seen = np.frombuffer(raw, "<i8", 3).tolist()
            n.append(np.frombuffer(raw, "<i8", n_entries, 24))
            place, parts = 24 + 8 * n_entries, []
            for count in (n_chunks, n_chunks, n_entries, n_entries, n_entries, n_seen):
                parts.append(np.frombuffer(raw, "<u4", count, place).astype(np.int64))
                place += 4 * count
            size, per_chunk = parts[:2]
            offsets = np.concatenate([[0], np.cumsum(size)])
            chunks.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), n_chunks, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw[place:])]))
            code.append(np.repeat(np.arange(n_chunks) + at, per_chunk))
            at += n_chunks
            group.append(np.array([number[g] for g in zip(langs, sources)], np.int64)[parts[2]])
            docs.append(parts[3])
            listed.append(parts[4])
            seen.append(parts[5] + (task << 32))
        distinct = pa.concat_arrays(chunks).dictionary_encode()
        self.chunks = distinct.dictionary
        self.code = distinct.indices.to_numpy()[np.concatenate(code)].astype(np.int64)
        self.group, self.n, self.docs, self.listed, self.seen = (np.concatenate(x) for x in (group, n, docs, listed, seen))


def _factor(table: pa.Table, min_docs: int) -> pa.Table:
    """Each distinct chunk of a bucket is cut into terms, which take over its counts: a row per chunk, language and term,
    with the sources' counts, the number of documents, and which, if they are few."""
    u = _Unpacked(table)
    n_groups = len(u.names)
    key = u.code * n_groups + u.group
    order = np.argsort(key, kind="stable")
    at = _edges(key[order])
    code, group = np.divmod(key[order][at[:-1]], n_groups)
    n, docs, listed = (_sums(x[order], at) for x in (u.n, u.docs, u.listed))
    seen = u.seen[_within((np.cumsum(u.listed) - u.listed)[order], u.listed[order])]
    lang = np.unique([g[0] for g in u.names], return_inverse=True)[1]
    run = _edges(code, lang[group])  # entries of one chunk and language
    run_docs, run_listed = _sums(docs, run), _sums(listed, run)
    few = run_docs < min_docs
    found = [Counter(t.lower() for t in TERM.findall(c)) for c in u.chunks.to_pylist()]  # bytes: A-Z only
    per_chunk = np.array([len(f) for f in found], np.int64)
    terms = pa.array([t for f in found for t in f], pa.binary()).cast(pa.string())
    times = np.array([k for f in found for k in f.values()], np.int64)
    run_code = code[run[:-1]]
    row = np.repeat(np.arange(len(run_code)), per_chunk[run_code])
    term = _within((np.cumsum(per_chunk) - per_chunk)[run_code], per_chunk[run_code])
    size, kept = np.diff(run)[row], np.where(few, run_listed, 0)[row]
    entry = _within(run[:-1][row], size)
    lists = lambda values, sizes: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)
    names = pa.array([s for _, s in u.names], pa.string())
    return pa.table({
        "lang": pa.array([g[0] for g in u.names], pa.string()).take(pa.array(group[run[:-1]][row])), "term": terms.take(pa.array(term)),
        "docs": run_docs[row], "seen": lists(pa.array(seen[_within((np.cumsum(run_listed) - run_listed)[row], kept)]), kept),
        "sources": lists(names.take(pa.array(group[entry])), size), "ns": lists(pa.array(n[entry] * np.repeat(times[term], size)), size)})


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _counted(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(counts, kept): (lang, source, term, n) of kept terms, and the kept terms (lang, term)."""
    buckets, flush_words = bucket_count(text_bytes(docs), BUCKET_BYTES, docs.sparkSession), FLUSH_WORDS
    packs = _read(docs).mapInArrow(lambda it: _count_chunks(it, buckets, min_docs, flush_words), _PACK_DDL)
    factored = packs.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(lambda t: _factor(t, min_docs), _TERMS_DDL)
    factored = stored(factored, "divergence-terms")
    bounds = factored.groupBy("lang", "term").agg(F.max("docs").alias("least"), F.sum("docs").alias("most"))
    bounds = stored(bounds.where(F.col("most") >= min_docs), "divergence-bounds")
    open_ = bounds.where(F.col("least") < min_docs).select("lang", "term")
    rows = factored.where(F.size("seen") > 0).join(open_, ["lang", "term"]).select("lang", "term", F.explode("seen").alias("row"))
    by_row = rows.distinct().groupBy("lang", "term").count().where(F.col("count") >= min_docs).select("lang", "term")
    kept = stored(bounds.where(F.col("least") >= min_docs).select("lang", "term").unionByName(by_row), "divergence-kept")
    each = factored.select("lang", "term", "sources", "ns").join(kept, ["lang", "term"]).select("lang", "term", F.explode(F.arrays_zip("sources", "ns")).alias("c"))
    counts = each.groupBy("lang", F.col("c.sources").alias("source"), "term").agg(F.sum("c.ns").alias("n"))
    return stored(counts, "divergence-counts"), kept


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n): occurrences of the terms that at least ``min_docs`` documents of the
    language hold, where a source has any.

    NULL text, lang and source read as ''.  Every row is a document, repeated ids and rows included; texts without a term
    and empty tables give no rows; other columns are ignored.
    """
    return _counted(docs, min_docs)[0]


# ---- divergence


def shares(n: np.ndarray, total, v: int) -> np.ndarray:
    """1 + floor(UNIT * (n + 2) / (total + 2 * v)) in exact arithmetic; 1 in a language without terms."""
    if not v:
        return np.ones(np.broadcast(n, total).shape, np.int64)
    if len(n) and max(int(n.max()), int(np.max(total))) > 2**62 // UNIT:  # beyond 64 bits
        n, total = n.astype(object), np.asarray(total).astype(object)
    return np.asarray(1 + UNIT * (n + 2) // (total + 2 * v), np.int64)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); both are at most UNIT + 1, so nothing overflows."""
    d = p - q
    return d * d // (p + q)


_COMPARED = "lang string, part string, source string, item string, value long, terms long, rest long"


def _compare(table: pa.Table, tile_terms: int, top: int) -> pa.Table:
    """One bucket of terms for the sources of two blocks: the sum of gaps over these terms for every two sources, and
    (once for each source) the terms it has most above its language.

    Rows without a term give the sources of a block with their totals; ``lang_n`` and ``v`` are the language's there.
    """
    lang, i, j = (table[c][0].as_py() for c in ("lang", "i", "j"))
    heads = table.filter(pc.is_null(table["term"])).to_pylist()
    names, total, block = ([x for h in heads for x in h["sources"]], np.array([x for h in heads for x in h["ns"]], np.int64),
                           np.array([h["block"] for h in heads for _ in h["sources"]]))
    v, lang_total = heads[0]["v"], heads[0]["lang_n"]
    zero = shares(np.zeros(len(names), np.int64), total, v)
    place = {s: k for k, s in enumerate(names)}
    rows = table.filter(pc.is_valid(table["term"])).combine_chunks()
    codes = rows["term"].combine_chunks().dictionary_encode()
    terms, sizes = codes.dictionary, pc.list_value_length(rows["sources"]).to_numpy()
    term = np.repeat(codes.indices.to_numpy(), sizes)
    of = rows["sources"].combine_chunks().flatten().dictionary_encode()
    source = np.array([place[s] for s in of.dictionary.to_pylist()], np.int64)[of.indices.to_numpy()] if len(of) else np.zeros(0, np.int64)
    n = rows["ns"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    of_lang = np.zeros(len(terms), np.int64)
    of_lang[codes.indices.to_numpy()] = rows["lang_n"].to_numpy()
    p, q = shares(n, total[source], v), shares(of_lang, np.full(len(terms), lang_total), v)
    order = np.argsort(term, kind="stable")
    term, source, p = term[order], source[order], p[order]
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    sums = np.zeros((len(names), len(names)), np.int64)
    for lo in range(0, len(terms), tile_terms):
        a, b = np.searchsorted(term, [lo, lo + tile_terms])
        tile = np.repeat(zero[:, None], min(tile_terms, len(terms) - lo), axis=1)
        tile[source[a:b], term[a:b] - lo] = p[a:b]
        for g in left:
            others = right[right > g] if i == j else right
            sums[g, others] += gap(tile[others], tile[g]).sum(axis=1)
    x, y = np.repeat(left, len(right)), np.tile(right, len(left))
    keep = x < y if i == j else np.ones(len(x), bool)
    x, y = x[keep], y[keep]
    out = [("pair", names[a], names[b], int(s), len(terms), int(z)) for a, b, s, z in zip(x, y, sums[x, y], gap(zero[x], zero[y]))]
    if i == j:
        high = np.flatnonzero(p > q[term])
        value = gap(p[high], q[term[high]])
        spelled = terms.to_pylist()
        rank = np.argsort(np.argsort(np.array(terms.cast(pa.binary()).to_pylist(), object))) if len(terms) else np.zeros(0, np.int64)
        by = np.lexsort((rank[term[high]], -value, source[high]))
        high, value = high[by], value[by]
        first = _edges(source[high])
        nth = np.arange(len(high)) - np.repeat(first[:-1], np.diff(first))
        out += [("term", names[source[k]], spelled[term[k]], int(f), 0, 0) for k, f in zip(high[nth < top], value[nth < top])]
    columns = list(zip(*out)) or [()] * 6
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
    return pa.table([pa.array([lang] * len(out), pa.string()), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                    names=["lang", "part", "source", "item", "value", "terms", "rest"])


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): each source's distance to every other one of its language
    (part ``pair``), and the terms that it holds more of than the language does (part ``term``, ``top`` of them).

    NULL text, lang and source read as ''; every row is a document, repeated ones included.  A source
    without terms is compared too; a language without kept terms gives pairs of value 0; an only source
    has no pairs; ties rank by item; empty tables give no rows; other columns are ignored.

    Sources are dealt to blocks and terms to buckets; a group holds one bucket's terms for two blocks,
    so neither many sources nor many terms make a group large.
    """
    counts, kept = _counted(docs, min_docs)
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("entries"))
    groups = _read(docs).select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").na.fill(0)
    groups = stored(groups.join(kept.groupBy("lang").agg(F.count("*").alias("v")), "lang", "left").na.fill(0), "divergence-groups")
    n = F.count("*")
    buckets = F.greatest(F.lit(1), F.ceil(F.sum("entries") / F.greatest(F.lit(ENTRIES_PER_BUCKET), n * n))).cast("int").alias("buckets")
    langs = groups.groupBy("lang").agg(F.ceil(n / SOURCES_PER_BLOCK).cast("int").alias("blocks"), buckets, F.sum("total").alias("lang_total"), F.max("v").alias("v"))
    block = F.expr("cast(pmod(xxhash64(source), blocks) as int)")
    heads = (groups.drop("v").join(langs, "lang").withColumn("block", block)
             .groupBy("lang", "block", "blocks", "buckets", F.col("lang_total").alias("lang_n"), "v")
             .agg(F.collect_list(F.struct("source", F.col("total").alias("n"))).alias("held"))  # a block's sources
             .withColumn("bucket", F.explode(F.expr("sequence(0, buckets - 1)"))).withColumn("term", F.lit(None).cast("string")).drop("buckets"))
    rows = (counts.join(langs.select("lang", "blocks", "buckets"), "lang").withColumn("block", block)
            .groupBy("lang", "term", "block", "blocks", "buckets").agg(F.collect_list(F.struct("source", "n")).alias("held"), F.sum("n").alias("block_n")))
    rows = rows.withColumn("lang_n", F.sum("block_n").over(Window.partitionBy("lang", "term"))).select(  # a row per block of sources
        "lang", "term", "block", "blocks", "held", "lang_n", F.lit(None).cast("long").alias("v"),
        F.expr("cast(pmod(xxhash64(term, 7), buckets) as int)").alias("bucket"))
    dealt = heads.unionByName(rows).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "bucket", "block", "term", "lang_n", "v",
        F.col("held.source").alias("sources"), F.col("held.n").alias("ns"))
    tile_terms = TERMS_PER_TILE
    compared = stored(dealt.groupBy("lang", "i", "j", "bucket").applyInArrow(lambda t: _compare(t, tile_terms, top), _COMPARED), "divergence-compared")
    # Terms that neither block holds add what two sources without occurrences are apart, for each of them.
    sums = compared.where("part = 'pair'").groupBy("lang", "source", "item", "rest").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    whole = sums.join(langs.select("lang", "v"), "lang").withColumn("value", F.col("value") + (F.col("v") - F.col("terms")) * F.col("rest"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = whole.select("lang", "value", both.alias("s")).select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    terms = compared.where("part = 'term'").select("lang", "source", "part", "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    return pairs.unionByName(terms).withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top)).select(
        "lang", "source", "part", "item", "value", "rank")
