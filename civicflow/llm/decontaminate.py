"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton reads the words of all items (lower-cased, punctuation ignored).  A
document's words stream through it: after each word it knows the longest suffix
of the words read so far that occurs in some item.  Where that length reaches the
window (10 words, or the whole of a shorter item), the window's words are hit and
the state names the items it occurs in.  Spans of hit words are cut out of the
text; a document whose hit share exceeds the coverage limit goes.

An automaton holds about AUTOMATON_WORDS item words; more items make more automata.  They are built in tasks, a
group of items each, and stored; executors fetch the files, and a task has one automaton in memory at a
time: it holds HELD_BYTES of text and runs it through one after the other.  Neither items nor automata come to
the driver, and documents are read once however many items there are.  Texts never shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.bytehash import ALNUM, LOWER, range_hashes, word_ranges
from civicflow.llm.common import byte_view, slices
from civicflow.session import scratch_path
from civicflow.sources.tables import folder_names

WINDOW = 10
MAX_COVERAGE = 0.5
AUTOMATON_WORDS = 200_000
HELD_BYTES = 32 << 20  # texts that a task holds while several automata read them


class SuffixAutomaton:
    """All substrings of several word sequences; states know which windows and short items end in them."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.step: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.ends: list[tuple[int, str, int]] = []  # (state, item, words up to here)
        self.items: dict[int, set[str]] = {}        # of the state whose strings include the window
        self.short: dict[int, set[str]] = {}        # of the state of a whole short item
        self.least = window                         # words of the shortest thing to find

    def _state(self, step: dict[int, int], link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """The state for the part of q that p extends by word."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(dict(self.step[q]), self.link[q], self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split(last, self.step[last][word], word)
        new = self._state({}, 0, self.length[last] + 1)
        p = last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.step[p][word], word)
        return new

    def add(self, item: str, words: list[int]) -> None:
        last = 0
        for n, word in enumerate(words, 1):
            last = self._extend(last, word)
            self.ends.append((last, item, n))
        if 0 < len(words) < self.window:
            self.ends.append((last, item, -1))
            self.least = min(self.least, len(words))

    def finish(self) -> "SuffixAutomaton":
        """Attach items to states once no state is split any more."""
        for state, item, n in self.ends:
            if n == -1:
                self.short.setdefault(state, set()).add(item)
            elif n >= self.window:
                self.items.setdefault(self._window_state(state), set()).add(item)
        self.ends = []
        self.short_of: list[tuple[int, ...]] = [()] * len(self.step)
        for v in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            above = self.short_of[self.link[v]]
            self.short_of[v] = (v, *above) if v in self.short else above
        return self

    def _window_state(self, v: int) -> int:
        while self.length[self.link[v]] >= self.window:
            v = self.link[v]
        return v

    def scan(self, words: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """(hit ranges, items) of a run of words."""
        spans, items = [], set()
        step, link, length = self.step, self.link, self.length
        v = matched = 0
        for i, word in enumerate(words, 1):
            while v and word not in step[v]:
                v = link[v]
                matched = length[v]
            nxt = step[v].get(word)
            if nxt is None:
                matched = 0
                continue
            v, matched = nxt, matched + 1
            if matched >= self.window:
                spans.append((i - self.window, i))
                items |= self.items[self._window_state(v)]
            for s in self.short_of[v]:
                if length[s] <= matched:
                    spans.append((i - length[s], i))
                    items |= self.short[s]
        return spans, items


class Matcher:
    """An automaton with its vocabulary: word hash -> number."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        texts = pa.array([t for _, t in items], pa.string())
        data, off = byte_view(texts)
        starts, ends, counts = word_ranges(data, off, ALNUM)
        h = range_hashes(data, starts, ends, LOWER)
        self.vocabulary = np.unique(h)
        number = (np.searchsorted(self.vocabulary, h) + 1).tolist()
        self.automaton = SuffixAutomaton(window)
        at = 0
        for (item, _), n in zip(items, counts.tolist()):
            self.automaton.add(item, number[at:at + n])
            at += n
        self.automaton.finish()

    def match(self, column: pa.Array):
        """Per row: (words, ranges of words hit, items); also the words' byte ranges."""
        data, off = byte_view(column)
        starts, ends, counts = word_ranges(data, off, ALNUM)
        first = np.cumsum(counts) - counts
        hits: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        if len(self.vocabulary) and len(starts):
            h = range_hashes(data, starts, ends, LOWER)
            at = np.searchsorted(self.vocabulary, h)
            at[at == len(self.vocabulary)] = 0
            number = np.where(self.vocabulary[at] == h, at + 1, 0)
            # An unknown word sends the automaton to its root, so only runs of known words
            # of one document, as long as the shortest thing to find, need streaming.
            known = number > 0
            cut = np.zeros(len(number) + 1, bool)
            cut[first[counts > 0]] = True
            left = np.flatnonzero(known & (np.r_[True, ~known[:-1]] | cut[:-1]))
            right = np.flatnonzero(known & (np.r_[~known[1:], True] | cut[1:])) + 1
            keep = right - left >= self.automaton.least
            rows = np.searchsorted(np.cumsum(counts), left[keep], side="right")
            for a, b, row in zip(left[keep].tolist(), right[keep].tolist(), rows.tolist()):
                spans, items = self.automaton.scan(number[a:b].tolist())
                if spans:
                    old = hits.setdefault(row, ([], set()))
                    old[0].extend((x + a - int(first[row]), y + a - int(first[row])) for x, y in spans)
                    old[1].update(items)
        return counts, hits, first, starts - np.repeat(off[:-1], counts), ends - np.repeat(off[:-1], counts)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def automata(items: DataFrame, window: int = WINDOW) -> list[str]:
    """Names of files with the automata of ``items`` (item_id, text), which executors can open as Spark files.

    A NULL item_id is the empty string; repeated items count once; an empty table gives no file.
    """
    spark = items.sparkSession
    slim = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").where("text is not null").distinct()
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-total // (AUTOMATON_WORDS * 6)))

    def build(table: pa.Table) -> pa.Table:
        found = Matcher(list(zip(table["item"].to_pylist(), table["text"].to_pylist())), window)
        return pa.table({"automaton": pa.array([pickle.dumps(found, pickle.HIGHEST_PROTOCOL)], pa.binary())})

    grouped = slim.withColumn("group", F.pmod(F.xxhash64("item", "text"), F.lit(groups)))
    path = scratch_path(spark, "automata")
    grouped.groupBy("group").applyInArrow(build, "automaton binary").write.parquet(path)
    names = [n for n in folder_names(spark, path) if n.endswith(".parquet")]
    for n in names:
        spark.sparkContext.addFile(f"{path}/{n}")
    return names


_LOADED: dict[tuple[str, int, int], Matcher] = {}  # at most one


def _each(names: list[str], back: bool) -> Iterator[Matcher]:
    """The automata one after the other, from the first or the last; the one read last stays loaded."""
    for name in reversed(names) if back else names:
        file = pq.ParquetFile(SparkFiles.get(name))
        rows = range(file.num_row_groups)
        for g in reversed(rows) if back else rows:
            blobs = file.metadata.row_group(g).num_rows
            for i in reversed(range(blobs)) if back else range(blobs):
                key = (name, g, i)
                if key not in _LOADED:
                    _LOADED.clear()
                    for k, batch in enumerate(file.iter_batches(batch_size=1, row_groups=[g])):
                        if k == i:
                            _LOADED[key] = pickle.loads(batch.column(0)[0].as_buffer())
                            break
                yield _LOADED[key]


def _matched(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, tuple]]:
    """(slice of rows, (words per row, hits, first word, word starts, word ends)) over all automata."""
    empty, held, size, back = Matcher([]), [], 0, False
    single = sum(pq.ParquetFile(SparkFiles.get(n)).metadata.num_rows for n in names) < 2  # then nothing is loaded twice

    def run() -> Iterator[tuple[pa.RecordBatch, tuple]]:
        seen = [[None, {}] for _ in held]
        for found in _each(names, back):
            for part, entry in zip(held, seen):
                words = found.match(part.column("text"))
                entry[0] = entry[0] or (words[0], *words[2:])
                for row, (spans, items) in words[1].items():
                    old = entry[1].setdefault(row, ([], set()))
                    old[0].extend(spans)
                    old[1].update(items)
        for part, (words, hits) in zip(held, seen):
            if words is None:  # no items at all
                counts, _, *words = empty.match(part.column("text"))
                words = (counts, *words)
            yield part, (words[0], {r: (merged(s), i) for r, (s, i) in hits.items()}, *words[1:])

    for batch in batches:
        for part in slices(batch, "text"):
            held.append(part)
            size += part.nbytes
            if single or size >= HELD_BYTES:
                yield from run()
                held, size, back = [], 0, not back
    yield from run()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, item_ids (sorted strings).

    NULL and blank texts have no words and no hits; an item without words is never found;
    repeated items count once; an empty table of items finds nothing.  Repeated and NULL
    doc_ids are carried through.  Other columns are ignored.
    """
    names = automata(items, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (counts, hits, *_) in _matched(names, batches):
            n_hit = np.zeros(part.num_rows, np.int64)
            ids: list[list[str]] = [[] for _ in range(part.num_rows)]
            for row, (spans, found) in hits.items():
                n_hit[row] = sum(b - a for a, b in spans)
                ids[row] = sorted(found)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array(n_hit), pa.array(ids, pa.list_(pa.string()))],
                names=["doc_id", "n_words", "n_hit", "item_ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_words bigint, n_hit bigint, item_ids array<string>")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` without benchmark passages, same columns.

    Bytes from a hit span's first word to its last are cut, and ``n_chars`` (where there is
    such a column) follows; documents with more than ``max_coverage`` of their words hit go.
    Clean documents are passed on untouched, extra columns too; NULL texts stay NULL; repeated rows are treated alike;
    an empty table gives no rows, and an empty table of items changes nothing.
    """
    names, text_at = automata(items, window), docs.columns.index("text")
    chars_at = docs.columns.index("n_chars") if dict(docs.dtypes).get("n_chars") == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (counts, hits, first, starts, ends) in _matched(names, batches):
            if not hits:
                yield part
                continue
            texts = part.column("text").to_pylist()
            stay = np.ones(part.num_rows, bool)
            for row, (spans, _) in hits.items():
                if sum(b - a for a, b in spans) > max_coverage * counts[row]:
                    stay[row] = False
                    continue
                raw, kept, at = texts[row].encode(), [], 0
                for a, b in spans:
                    kept.append(raw[at:starts[first[row] + a]])
                    at = ends[first[row] + b - 1]
                texts[row] = b"".join([*kept, raw[at:]]).decode()
            columns = list(part.columns)
            columns[text_at] = pa.array(texts, part.schema.field(text_at).type)
            if chars_at is not None:
                chars = part.column(chars_at).to_pylist()
                for row in hits:
                    chars[row] = len(texts[row])
                columns[chars_at] = pa.array(chars, pa.int64())
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema).filter(pa.array(stay))

    return docs.mapInArrow(run, docs.schema)
