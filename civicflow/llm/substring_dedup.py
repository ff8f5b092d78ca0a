"""Repeated passages: difference-cover anchors find them, full windows decide.

A window is 20 consecutive words.  It goes where its word sequence also starts
earlier: in a document with a smaller id, or earlier in the same one.

Method
* The cover {0, 1, 3, 9} modulo 13 has every difference modulo 13.  So for any
  two places that hold the same 20 words there is a shift of at most 12 after
  which both stand on cover positions; the 8 words from there on lie inside both
  windows.  Hashing 8-word anchors at cover positions alone (4 of 13) therefore
  meets every repeated window.
* Anchors are dealt to hash buckets, which tell the documents which of their
  anchors occur elsewhere.  A mapper settles what it can see itself and sends each
  distinct anchor once per flush, so an anchor that a third of the documents hold
  reaches its bucket once per flush, not once per document.
* Extension: only windows around a shared anchor are hashed in full, twice with independent hashes of
  their words; each distinct window's smallest (document, start) stays, every other one marks its words.  Windows are
  equal where both hashes are: one alone would take different windows for one at 10^13 of them.  (Anchors
  that are taken for one by chance only cause more windows to be looked at.)

Texts cross the network once, to meet their shared anchors.  Documents without any
are finished there; the others are written to the shared folder for the second step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.bytehash import NOT_SPACE, mix, range_hashes, sequence_hashes, word_ranges
from civicflow.llm.common import bucket_count, byte_view, slices, stored, text_bytes

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
WINDOW_SEEDS = (0, 1)  # independent hashes of a window
BUCKET_BYTES = 16 << 20  # text whose anchors one bucket gathers
FLUSH_PLACES = 500_000  # anchors or windows that a mapper holds before it sends them on

NO_ID = 2**63 - 1
PACK = "bucket int, ids binary, keys binary, runs binary, places binary, hashes binary"
MARKS = "id bigint, key bigint, places binary"
_PACK_NAMES = ["bucket", "ids", "keys", "runs", "places", "hashes"]
COPY = -1  # a document whose whole text another one with a smaller id has


def _runs(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first position, length) of each run of equal values."""
    edge = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else np.zeros(1, np.int64)
    return edge[:-1], np.diff(edge).astype(np.int32)


def _own_bucket(ids: np.ndarray, keys: np.ndarray, buckets: int) -> np.ndarray:
    """A document's bucket; copies of a text have buckets of their own."""
    return (mix(keys.view(np.uint64) ^ mix(ids.view(np.uint64))) % np.uint64(buckets)).astype(np.int32)


def _packs(bucket: np.ndarray, doc: np.ndarray, ids: np.ndarray, keys: np.ndarray, place: np.ndarray,
           h: np.ndarray | None) -> pa.RecordBatch:
    """One row per bucket; places of a document stand together."""
    order = np.lexsort((place, doc, bucket))
    bucket, doc, place = bucket[order], doc[order], place[order]
    h = None if h is None else h[order]
    rows = []
    for a, n in zip(*_runs(bucket)):
        first, size = _runs(doc[a:a + n])
        d = doc[a:a + n][first]
        rows.append((int(bucket[a]), ids[d].tobytes(), keys[d].tobytes(), size.tobytes(),
                     place[a:a + n].astype(np.int32).tobytes(), None if h is None else h[a:a + n].tobytes()))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32())]
                                      + [pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 6)], names=_PACK_NAMES)


def _by_hash(h: np.ndarray, ids: np.ndarray, keys: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Order by hash (all its lanes), document and place."""
    return np.lexsort((place, keys, ids, *h.T[::-1]))


def _elsewhere(h, ids, keys, place, earliest: bool) -> tuple[np.ndarray, np.ndarray]:
    """For places sorted by hash and document: (first of its hash, occurs elsewhere).

    With ``earliest``, elsewhere means before it.  Repeated rows of one document hold
    the same place; they don't count as elsewhere.
    """
    if not len(h):
        return np.zeros(0, bool), np.zeros(0, bool)
    new = np.r_[True, (h[1:] != h[:-1]).any(axis=1)]
    group = np.cumsum(new) - 1
    head = np.flatnonzero(new)[group]
    other = (ids != ids[head]) | (keys != keys[head]) | (place != place[head])
    return new, other if earliest else np.bincount(group, weights=other)[group] > 0


class _Flush:
    """Places held by a mapper: (hash, document, place) with the documents' ids and keys."""

    def __init__(self, buckets: int, earliest: bool):
        self.buckets, self.earliest = buckets, earliest
        self.clear()

    def clear(self) -> None:
        self.h, self.doc, self.place, self.ids, self.keys, self.docs, self.n = [], [], [], [], [], 0, 0

    def add(self, ids, keys, h, doc, place) -> None:
        self.h.append(h)
        self.doc.append(doc + self.docs)
        self.place.append(place)
        self.ids.append(ids)
        self.keys.append(keys)
        self.docs += len(ids)
        self.n += len(h)

    def send(self) -> Iterator[pa.RecordBatch]:
        if self.docs:
            h, doc, place = (np.concatenate(x) for x in (self.h, self.doc, self.place))
            ids, keys = np.concatenate(self.ids), np.concatenate(self.keys)
            own = _own_bucket(ids, keys, self.buckets)
            yield from self.send_places(h, doc, place, ids, keys, own)
        self.clear()

    def send_places(self, h, doc, place, ids, keys, own) -> Iterator[pa.RecordBatch]:
        whole = place == COPY
        if whole.any():
            yield _packs(own[doc[whole]], doc[whole], ids, keys, place[whole], None)
            h, doc, place = h[~whole], doc[~whole], place[~whole]
        order = _by_hash(h, ids[doc], keys[doc], place)
        h, doc, place = h[order], doc[order], place[order]
        new, known = _elsewhere(h, ids[doc], keys[doc], place, self.earliest)
        # What this mapper can tell by itself: for anchors all that occur twice here,
        # for windows all but the earliest one.
        if known.any():
            yield _packs(own[doc[known]], doc[known], ids, keys, place[known], None)
        if new.any():
            bucket = ((h[:, 0] >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int32)
            yield _packs(bucket[new], doc[new], ids, keys, place[new], h[new])


def _words(part: pa.RecordBatch, seeds: tuple[int, ...] = (0,)) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all words for each seed, words per row, ids, keys)."""
    data, off = byte_view(part.column("text"))
    starts, ends, counts = word_ranges(data, off, NOT_SPACE)
    return [range_hashes(data, starts, ends, seed=s) for s in seeds], counts, np.asarray(part.column("id")), np.asarray(part.column("key"))


def _spread(counts: np.ndarray, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For ``per_row`` places of each row: (row, place, position among all words)."""
    row = np.repeat(np.arange(len(counts)), per_row)
    place = np.arange(int(per_row.sum())) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    return row, place, (np.cumsum(counts) - counts)[row] + place


def _anchors(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    flush = _Flush(buckets, earliest=False)
    seen: dict[int, int] = {}
    on_cover = np.isin(np.arange(PERIOD), COVER)
    for batch in batches:
        for part in slices(batch, "text"):
            (words,), counts, ids, keys = _words(part)
            # Of equal texts that meet here the one with the smallest id speaks for all so far.
            use = np.zeros(len(ids), bool)
            copies = []
            for i in np.argsort(ids, kind="stable"):
                first = seen.setdefault(int(keys[i]), int(ids[i]))
                use[i] = first == ids[i] or first > ids[i]
                if use[i]:
                    seen[int(keys[i])] = int(ids[i])
                elif counts[i] >= WINDOW:
                    copies.append(i)
            row, place, at = _spread(counts, np.where(use & (counts >= WINDOW), np.maximum(counts - ANCHOR + 1, 0), 0))
            mine = on_cover[place % PERIOD]
            row, place, at = row[mine], place[mine], at[mine]
            h = sequence_hashes(words, at, ANCHOR)
            flush.add(ids, keys, np.r_[h, np.zeros(len(copies), np.uint64)][:, None], np.r_[row, np.array(copies, np.int64)],
                      np.r_[place, np.full(len(copies), COPY)])
            if flush.n >= FLUSH_PLACES:
                yield from flush.send()
                seen.clear()
    yield from flush.send()


def _windows(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    flush = _Flush(buckets, earliest=True)
    for batch in batches:
        for part in slices(batch, "text"):
            lanes, counts, ids, keys = _words(part, WINDOW_SEEDS)
            per_row = np.maximum(counts - WINDOW + 1, 0)
            base = np.cumsum(per_row) - per_row
            delta = np.zeros(int(per_row.sum()) + 1, np.int64)  # +1 and -1 around the windows of a shared anchor
            _, o = byte_view(part.column("places"))
            raw, _ = byte_view(part.column("places"))
            place = raw.view(np.int32) if len(raw) else np.zeros(0, np.int32)
            row = np.repeat(np.arange(len(counts)), np.diff(o) // 4)
            lo = np.clip(place - (WINDOW - ANCHOR), 0, None)
            hi = np.minimum(place, per_row[row] - 1) + 1
            ok = hi > lo
            np.add.at(delta, base[row[ok]] + lo[ok], 1)
            np.add.at(delta, base[row[ok]] + hi[ok], -1)
            row, place, at = _spread(counts, per_row)
            mine = np.cumsum(delta[:-1]) > 0
            row, place, at = row[mine], place[mine], at[mine]
            flush.add(ids, keys, np.stack([sequence_hashes(words, at, WINDOW) for words in lanes], axis=1), row, place)
            if flush.n >= FLUSH_PLACES:
                yield from flush.send()
    yield from flush.send()


def _unpacked(table: pa.Table, lanes: int = 1) -> tuple[np.ndarray, ...]:
    """(ids, keys, places, hashes, already known) of a bucket, a row per place."""
    ids, keys, place, h, known = [], [], [], [], []
    for i, k, r, p, x in zip(*(table.column(c) for c in _PACK_NAMES[1:])):
        runs = np.frombuffer(r.as_buffer(), np.int32)
        ids.append(np.repeat(np.frombuffer(i.as_buffer(), np.int64), runs))
        keys.append(np.repeat(np.frombuffer(k.as_buffer(), np.int64), runs))
        place.append(np.frombuffer(p.as_buffer(), np.int32))
        known.append(np.full(len(place[-1]), not x.is_valid))
        h.append(np.frombuffer(x.as_buffer(), np.uint64).reshape(-1, lanes) if x.is_valid else np.zeros((len(place[-1]), lanes), np.uint64))
    return tuple(np.concatenate(x) for x in (ids, keys, place, h, known))


def _by_document(ids: np.ndarray, keys: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """(ids, keys, places) sorted by document, and where each document begins, and the end."""
    order = np.lexsort((place, keys, ids))
    ids, keys, place = ids[order], keys[order], place[order]
    edge = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]), True]) if len(ids) else np.zeros(1, np.int64)
    return ids, keys, place, edge


def _settle(table: pa.Table, earliest: bool, buckets: int) -> pa.Table:
    """One bucket of hashes: the places of what occurs elsewhere (earlier elsewhere, for windows), dealt by document."""
    ids, keys, place, h, known = _unpacked(table, len(WINDOW_SEEDS) if earliest else 1)
    out = [(ids[known], keys[known], place[known])]
    ids, keys, place, h = (x[~known] for x in (ids, keys, place, h))
    order = _by_hash(h, ids, keys, place)
    ids, keys, place, h = (x[order] for x in (ids, keys, place, h))
    _, mark = _elsewhere(h, ids, keys, place, earliest)
    out.append((ids[mark], keys[mark], place[mark]))
    ids, keys, place, edge = _by_document(*(np.concatenate([o[k] for o in out]) for k in range(3)))
    first, doc = edge[:-1], np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    own = _own_bucket(ids[first], keys[first], buckets)
    return pa.Table.from_batches([_packs(own[doc], doc, ids[first], keys[first], place, None)])


def _gather(table: pa.Table) -> pa.Table:
    """One bucket of documents: (id, key, places) of each."""
    ids, keys, place, edge = _by_document(*_unpacked(table)[:3])
    first = edge[:-1]
    return pa.table({"id": pa.array(ids[first]), "key": pa.array(keys[first]),
                     "places": pa.array([place[a:b].astype(np.int32).tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())})


def _marks(packs: DataFrame, buckets: int, earliest: bool) -> DataFrame:
    """Per document (id, key): all its marked places.  Buckets of hashes, then buckets of documents."""
    dealt = packs.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(lambda t: _settle(t, earliest, buckets), PACK)
    return dealt.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_gather, MARKS)


def _finish_or_keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without a shared anchor, and whole copies, are done; the others keep text and places."""
    for batch in batches:
        for part in slices(batch, "text"):
            rows = []
            for ident, key, doc_id, text, places in zip(*(part.column(c).to_pylist() for c in ("id", "key", "doc_id", "text", "places"))):
                marked = np.frombuffer(places, np.int32) if places is not None else None
                if marked is not None and not (marked == COPY).any():
                    rows.append((ident, key, doc_id, None, None, None, text, places))
                    continue
                words = (text or "").encode().split()
                gone = marked is not None
                kept = b"" if gone else b" ".join(words)
                rows.append((ident, key, doc_id, len(words), len(words) if gone else 0, kept.decode(), None, None))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                                                                           pa.string(), pa.string(), pa.binary()))],
                names=["id", "key", "doc_id", "n_words", "n_removed", "kept", "text", "places"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            rows = []
            for doc_id, text, places in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "places"))):
                words = (text or "").encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                if places is not None:
                    p = np.frombuffer(places, np.int32)
                    np.add.at(gone, p, 1)
                    np.add.at(gone, p + WINDOW, -1)
                stay = np.cumsum(gone[:-1]) <= 0
                kept = b" ".join(words) if stay.all() else b" ".join([words[i] for i in np.flatnonzero(stay)])
                rows.append((doc_id, len(words), int((~stay).sum()), kept.decode()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words that stay, joined by one space).

    NULL, empty and blank texts have no words.  Rows that repeat both doc_id and text are one
    document and get the same result; rows of equal doc_id but different text are ordered by a
    hash of the text; a NULL doc_id comes after all others.  Other columns are ignored; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    keyed = docs.select("doc_id", "text").withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))) \
                .withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
    buckets = bucket_count(text_bytes(docs), BUCKET_BYTES, spark)
    shared = _marks(keyed.select("id", "key", "text").mapInArrow(lambda it: _anchors(it, buckets), PACK), buckets, False)
    half = stored(keyed.join(shared, ["id", "key"], "left").select("id", "key", "doc_id", "text", "places")
                  .mapInArrow(_finish_or_keep, "id bigint, key bigint, doc_id bigint, n_words bigint, n_removed bigint,"
                                               " kept string, text string, places binary"), "repeat-anchors")
    done = half.where("n_words is not null").select("doc_id", "n_words", "n_removed", "kept")
    todo = half.where("n_words is null")
    again = _marks(todo.select("id", "key", "text", "places").mapInArrow(lambda it: _windows(it, buckets), PACK), buckets, True)
    cut = (todo.drop("places").join(again, ["id", "key"], "left").select("doc_id", "text", "places")
           .mapInArrow(_cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string"))
    return done.unionByName(cut)
