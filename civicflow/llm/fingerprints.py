"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut at line ends, and each paragraph again after words whose hash says
so (one in four), so a piece depends on its own words only and an edit leaves the
other pieces alone.  Each piece's digest, with the number of its equal predecessors,
is added to one cell in each of three parts of a table (count, xor of digests,
xor of checks).  Tables subtract cell by cell: pieces that both versions hold
cancel, and peeling recovers the rest from cells that hold exactly one.  If peeling
gets stuck the tables are rebuilt four times larger, until it ends.

Sketches of thousands of texts lie side by side in flat arrays, so building,
subtracting and peeling are a few numpy passes for a slice of rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.bytehash import NOT_SPACE, mix, range_hashes, word_ranges
from civicflow.llm.common import SLICE_BYTES, bucket_count, byte_view, slices, stored, text_bytes

PARTS = 3
CELLS = 24          # of a stored fingerprint, over all parts
GROWTH = 4          # a stuck comparison is retried with so many times the cells
CUT_ONE_IN = 4      # words of a paragraph that end a piece
SAMPLES = 50        # rows looked at for each range of documents, to cut ranges of near equal size
BUCKET_BYTES = 32 << 20
_CHECK = np.uint64(0xC2B2AE3D27D4EB4F)


def pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(digest, row) of the pieces of each text, counting equal pieces of a text apart."""
    data, off = byte_view(pa.array(texts, pa.large_string()))
    starts, ends, counts = word_ranges(data, off, NOT_SPACE)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(texts)), counts)
    words = range_hashes(data, starts, ends)
    lines = np.searchsorted(np.flatnonzero(data == 10), starts)
    last = (words >> np.uint64(40)) % np.uint64(CUT_ONE_IN) == 0
    last[:-1] |= lines[1:] != lines[:-1]
    last[:-1] |= row[1:] != row[:-1]
    last[-1] = True
    end = np.flatnonzero(last)
    first = np.r_[0, end[:-1] + 1]
    # Order matters within a piece: each word is scrambled with its place in it.
    place = np.arange(len(words)) - np.repeat(first, end - first + 1)
    digest = mix(np.add.reduceat(mix(words + place.astype(np.uint64) * _CHECK), first))
    row = row[first]
    order = np.lexsort((digest, row))
    digest, row = digest[order], row[order]
    new = np.r_[True, (digest[1:] != digest[:-1]) | (row[1:] != row[:-1])]
    nth = np.arange(len(digest)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    return mix(digest + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), row


class Sketches:
    """One table of ``cells`` cells per row, flat: counts, xor of digests, xor of checks."""

    def __init__(self, rows: int, cells: int):
        self.part = -(-cells // PARTS)
        self.rows, self.width = rows, self.part * PARTS
        self.count = np.zeros(rows * self.width, np.int64)
        self.keys = np.zeros(rows * self.width, np.uint64)
        self.checks = np.zeros(rows * self.width, np.uint64)

    def put(self, digest: np.ndarray, row: np.ndarray, sign) -> None:
        check = mix(digest ^ _CHECK)
        for p in range(PARTS):
            cell = row * self.width + p * self.part + (mix(digest + np.uint64(p + 1)) % np.uint64(self.part)).astype(np.int64)
            np.add.at(self.count, cell, sign)
            np.bitwise_xor.at(self.keys, cell, digest)
            np.bitwise_xor.at(self.checks, cell, check)

    def encoded(self) -> list[str]:
        """The stored form: every cell whole, so what is read back is the table that was written."""
        raw = np.stack([self.count.view(np.uint64), self.keys, self.checks], axis=1).astype("<u8").tobytes()
        size = 24 * self.width
        return [base64.b64encode(raw[i * size:(i + 1) * size]).decode() for i in range(self.rows)]

    @classmethod
    def decoded(cls, stored: list[str]) -> "Sketches":
        """The tables of stored fingerprints of one width."""
        raw = np.frombuffer(b"".join(map(base64.b64decode, stored)), "<u8").astype(np.uint64).reshape(-1, 3)
        out = cls(len(stored), len(raw) // max(1, len(stored)))
        out.count, out.keys, out.checks = raw[:, 0].copy().view(np.int64), raw[:, 1].copy(), raw[:, 2].copy()
        return out

    def minus(self, other: "Sketches") -> "Sketches":
        out = Sketches(self.rows, self.width)
        out.count, out.keys, out.checks = self.count - other.count, self.keys ^ other.keys, self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(digest, row, sign) of what differs, and whether each row came out completely.

        Rounds over all rows at once; only cells touched in a round are looked at in the next.
        """
        found = []
        cell = np.flatnonzero(self.count)
        while len(cell):
            pure = cell[(np.abs(self.count[cell]) == 1) & (mix(self.keys[cell] ^ _CHECK) == self.checks[cell])]
            if not len(pure):
                break
            row, digest, sign = pure // self.width, self.keys[pure], self.count[pure]
            order = np.lexsort((digest, row))
            row, digest, sign = row[order], digest[order], sign[order]
            new = np.r_[True, (row[1:] != row[:-1]) | (digest[1:] != digest[:-1])]
            row, digest, sign = row[new], digest[new], sign[new]
            found.append((digest, row, sign))
            self.put(digest, row, -sign)
            cell = np.unique(np.concatenate([
                row * self.width + p * self.part + (mix(digest + np.uint64(p + 1)) % np.uint64(self.part)).astype(np.int64)
                for p in range(PARTS)]))
            cell = cell[self.count[cell] != 0]
        whole = ~((self.count != 0) | (self.keys != 0)).reshape(self.rows, -1).any(axis=1)
        if not found:
            z = np.zeros(0, np.int64)
            return z.astype(np.uint64), z, z, whole
        return (*(np.concatenate([f[k] for f in found]) for k in range(3)), whole)


def sketch(digest: np.ndarray, row: np.ndarray, rows: int, cells: int = CELLS) -> Sketches:
    out = Sketches(rows, cells)
    out.put(digest, row, 1)
    return out


def differing(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], rows: int,
              first: Sketches | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Recovered (digest, row, sign) of pieces that only a (+1) or only b (-1) has.

    ``first`` is the difference of the stored fingerprints; rows it can't resolve are
    retried with larger tables.
    """
    out, cells, todo = [], CELLS, np.arange(rows)
    diff = first if first is not None else sketch(*a, rows).minus(sketch(*b, rows))
    while True:
        digest, row, sign, whole = diff.peel()
        good = whole[row]
        out.append((digest[good], todo[row[good]], sign[good]))
        todo = todo[~whole]
        if not len(todo):
            return tuple(np.concatenate([o[k] for o in out]) for k in range(3))
        cells *= GROWTH
        at = np.full(rows, -1)
        at[todo] = np.arange(len(todo))
        pick = lambda s: (s[0][at[s[1]] >= 0], at[s[1]][at[s[1]] >= 0])
        diff = sketch(*pick(a), len(todo), cells).minus(sketch(*pick(b), len(todo), cells))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], rows: int, diff: Sketches) -> np.ndarray:
    """1 - differing pieces / all pieces of both; two texts without pieces are alike."""
    _, row, _ = differing(a, b, rows, diff)
    total = np.bincount(a[1], minlength=rows) + np.bincount(b[1], minlength=rows)
    return np.where(total > 0, 1 - np.bincount(row, minlength=rows) / np.maximum(total, 1), 1.0)


def edited(text: str, after: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``after``."""
    k = len(text) // 3
    return text[:len(text) - k] + after[:k]


def _compare(doc_ids: list, texts: list[str], nexts: list[str]) -> pa.RecordBatch:
    n = len(texts)
    edits = [edited(t, a) for t, a in zip(texts, nexts)]
    own, edit, after = pieces(texts), pieces(edits), pieces(nexts)
    stored = [sketch(*x, n).encoded() for x in (own, edit, after)]
    mine, theirs, follow = map(Sketches.decoded, stored)  # the fingerprints themselves are compared
    columns = [pa.array(doc_ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
               pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits]), pa.array(stored[0], pa.string()),
               pa.array(stored[1], pa.string()), pa.array(likeness(own, edit, n, mine.minus(theirs))),
               pa.array(likeness(own, after, n, mine.minus(follow)))]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
          " near_edited double, near_next double")


def _range_of(down: np.ndarray, key: np.ndarray, bounds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The range of each row: how many bounds (down, key) are not above it."""
    tops, keys = bounds
    lo, hi = np.searchsorted(tops, down, "left"), np.searchsorted(tops, down, "right")
    out = lo.copy()
    for i in np.flatnonzero(hi > lo):  # rows whose id is a bound's: the key decides
        out[i] = lo[i] + np.searchsorted(keys[lo[i]:hi[i]], key[i], "right")
    return out


def _ranges(bounds):
    """(range, down, key): the first row of each range that a task saw."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[int, tuple[int, int]] = {}
        for batch in batches:
            down, key = (batch.column(c).to_numpy() for c in ("down", "key"))
            at = _range_of(down, key, bounds)
            order = np.lexsort((key, down, at))
            heads = order[np.flatnonzero(np.r_[True, at[order][1:] != at[order][:-1]])] if len(order) else order
            for r, d, k in zip(at[heads].tolist(), down[heads].tolist(), key[heads].tolist()):
                first[r] = min(first.get(r, (d, k)), (d, k))
        yield pa.RecordBatch.from_arrays([pa.array(list(first), pa.int32()), pa.array([d for d, _ in first.values()], pa.int64()),
                                          pa.array([k for _, k in first.values()], pa.int64())], names=["range", "down", "key"])

    return run


def _squeezed(bounds, guests: dict[tuple[int, int], int]):
    """Texts as Zstandard frames (a third less to shuffle than with the shuffle's own compression), with their range.

    Equal rows of a batch go once, with their number; a range's first row goes to the range before it too, as a guest.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = byte_view(part.column("text"))
                raw, ids = memoryview(np.ascontiguousarray(data)), part.column("doc_id").to_pylist()
                down, key = (part.column(c).to_numpy() for c in ("down", "key"))
                order = np.lexsort((key, down))
                times = Counter(zip(down.tolist(), key.tolist(), (bytes(raw[off[i]:off[i + 1]]) for i in range(part.num_rows))) if _repeats(down, key, order)
                                else ())
                seen, rows = set(), []
                for i, r in enumerate(_range_of(down, key, bounds).tolist()):
                    text = bytes(raw[off[i]:off[i + 1]])
                    row = (int(down[i]), int(key[i]), text)
                    if times and times[row] > 1:
                        if row in seen:
                            continue
                        seen.add(row)
                    frame, d, k = squeeze(text), int(down[i]), int(key[i])
                    rows.append((r, False, d, k, ids[i], frame, times[row] if times else 1))
                    if (d, k) in guests:
                        rows.append((guests[d, k], True, d, k, ids[i], frame, 1))
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], t) for c, t in enumerate(
                    (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))], names=_PACKED)

    return run


_PACKED = ["range", "guest", "down", "key", "doc_id", "packed", "times"]


def _repeats(down: np.ndarray, key: np.ndarray, order: np.ndarray) -> bool:
    d, k = down[order], key[order]
    return bool(((d[1:] == d[:-1]) & (k[1:] == k[:-1])).any())


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs each row with the row after it in its range; guests only serve as the last row's neighbour.

    A row that stands for several equal ones is its own neighbour for all but the last of them.
    """
    open_up = zstandard.ZstdDecompressor().decompress
    held = None  # the last row: (range, guest, doc_id, text)
    ids, texts, nexts, times, size = [], [], [], [], 0
    for batch in batches:
        for part in slices(batch, "packed"):
            for at, guest, doc_id, packed, n in zip(*(part.column(c).to_pylist() for c in ("range", "guest", "doc_id", "packed", "times"))):
                text = open_up(packed).decode()
                if held is not None and not held[1] and held[0] == at:
                    ids.append(held[2])
                    texts.append(held[3])
                    nexts.append(text)
                    times.append(1)
                if not guest and n > 1:
                    ids.append(doc_id)
                    texts.append(text)
                    nexts.append(text)
                    times.append(n - 1)
                size += 2 * len(text)
                if size > SLICE_BYTES and ids:
                    yield from _repeated(_compare(ids, texts, nexts), times)
                    ids, texts, nexts, times, size = [], [], [], [], 0
                held = (at, guest, doc_id, text)
    if ids:
        yield from _repeated(_compare(ids, texts, nexts), times)


def _repeated(rows: pa.RecordBatch, times: list[int]) -> Iterator[pa.RecordBatch]:
    if max(times) == 1:
        yield rows
        return
    for i, n in enumerate(times):
        for lo in range(0, n, 1000):
            yield rows.take(pa.array(np.full(min(1000, n - lo), i)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with its fingerprint, its edited text's, and their likeness (see RESULT).

    The next document is the one with the next smaller doc_id; after the last comes the first; a
    document alone is its own next.  NULL ids come last, rows of equal id stand in a fixed order of their texts.  A
    NULL text is empty: no pieces, an empty sketch.  Other columns are ignored; an empty table gives
    no rows.

    Neighbours meet in one shuffle of the texts: rows are ranged by (id, hash of the text), between bounds taken
    from a sample of the rows themselves, so sparse ids or many NULL ones make no range large; each range is
    sorted where it lands, and the first row of the next one comes along as a guest.  Bounds and first
    rows (two numbers per range) pass through the driver.
    """
    spark = docs.sparkSession
    # Ascending ``down`` is descending id, NULL last.
    down = F.bitwise_not(F.coalesce("doc_id", F.lit(-2**63))).alias("down")
    keyed = docs.select("doc_id", "text", down, F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    slim = stored(keyed.select("down", "key"), "fingerprint-keys")
    n_rows = slim.count()
    if not n_rows:
        return spark.createDataFrame([], RESULT)
    ranges = min(bucket_count(text_bytes(docs), BUCKET_BYTES, spark), n_rows)
    every = max(1, n_rows // (SAMPLES * ranges))
    sample = sorted(map(tuple, slim.where(F.pmod(F.xxhash64("down", "key", F.lit(3)), F.lit(every)) == 0).distinct().collect()))
    cuts = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if sample else []
    cuts = sorted(set(cuts))
    bounds = (np.array([d for d, _ in cuts], np.int64), np.array([k for _, k in cuts], np.int64))
    heads = slim.mapInArrow(_ranges(bounds), "range int, down bigint, key bigint").groupBy("range").agg(F.min(F.struct("down", "key")).alias("first"))
    firsts = {r["range"]: (r["first"]["down"], r["first"]["key"]) for r in heads.collect()}
    order = sorted(firsts)
    guests = {firsts[r]: order[i - 1] for i, r in enumerate(order)}  # the first range's first row follows the last range
    packed = keyed.mapInArrow(_squeezed(bounds, guests), "range int, guest boolean, down bigint, key bigint, doc_id bigint, packed binary, times bigint")
    return (packed.repartition(len(order), "range").sortWithinPartitions("range", "guest", "down", "key", "packed")
            .select("range", "guest", "doc_id", "packed", "times").mapInArrow(_in_order, RESULT))
