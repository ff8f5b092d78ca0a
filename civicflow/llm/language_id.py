"""Language ID: a bidirectional gated recurrent network over UTF-8 bytes.

Training is plain numpy: forward and backward recurrent layers, a softmax at
every position, backpropagation through time and Adam.  It sees windows of bytes
of a bounded sample of labelled rows (SAMPLE_PER_LANG distinct texts per language, those
with the smallest hash; up to WINDOWS_PER_DOC windows of each).

Prediction reads every byte of every text.  A text is read in windows of WINDOW
bytes side by side, so thousands of positions advance in one matrix product and a
long text needs no more memory than a short one.  Every position gets language
probabilities; a document's are their mean.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicflow.llm.common import byte_view, slices

UNKNOWN = "und"
HIDDEN = 8
WINDOW = 64
SAMPLE_PER_LANG = 250
WINDOWS_PER_DOC = 4
OVERSAMPLE = 8  # times per_lang: distinct texts that the hash bound is to let through
STEPS = 160
BATCH = 192
RATE = 0.02
BLOCK = 4096  # windows advanced together


class ByteGRU:
    """Weights of both directions and of the output layer; float32."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs, self.hidden = langs, hidden
        f = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.w = {}
        for d in ("f", "b"):
            self.w[f"e{d}"] = f(256, 3 * hidden, scale=0.3)       # what a byte adds to the gates, biases included
            self.w[f"u{d}"] = f(hidden, 3 * hidden, scale=hidden ** -0.5)
            self.w[f"c{d}"] = np.zeros(hidden, np.float32)          # bias inside the reset gate's product
            self.w[f"o{d}"] = f(hidden, len(langs), scale=hidden ** -0.5)
        self.w["bias"] = np.zeros(len(langs), np.float32)

    def _layer(self, x: np.ndarray, d: str, keep: bool):
        """States (steps, hidden, windows) after each byte of x (steps, windows); with ``keep`` also
        what the backward pass needs.  Windows lie along the last axis, so every operation is long."""
        h_n, c = self.hidden, self.w[f"c{d}"][:, None]
        e, u = np.ascontiguousarray(self.w[f"e{d}"].T), np.ascontiguousarray(self.w[f"u{d}"].T)
        h = np.zeros((h_n, x.shape[1]), np.float32)
        states = np.empty((len(x), h_n, x.shape[1]), np.float32)
        a = np.empty((3 * h_n, x.shape[1]), np.float32)
        saved = []
        order = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        for t in order:
            np.take(e, x[t], axis=1, out=a, mode="clip")
            g = u @ h
            gates = a[:2 * h_n] + g[:2 * h_n]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            z, r = gates[:h_n], gates[h_n:]
            q = g[2 * h_n:]
            q += c
            n = r * q
            n += a[2 * h_n:]
            np.tanh(n, out=n)
            if keep:
                saved.append((t, h, z, r, q, n))
            step = h - n
            step *= z
            h = np.add(n, step, out=states[t])
        return states, saved

    def probabilities(self, x: np.ndarray, keep: bool = False):
        """(steps, languages, windows) for bytes x (steps, windows)."""
        x = x.astype(np.intp)
        f, saved_f = self._layer(x, "f", keep)
        b, saved_b = self._layer(x, "b", keep)
        p = self.w["of"].T @ f
        p += self.w["ob"].T @ b
        p += self.w["bias"][:, None]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return (p, f, b, saved_f, saved_b) if keep else p

    def _back(self, x: np.ndarray, d: str, saved, d_states: np.ndarray, grad: dict) -> None:
        """Backpropagation through time for one direction."""
        h_n, u = self.hidden, self.w[f"u{d}"]
        grad[f"e{d}"] = np.zeros((256, 3 * h_n), np.float32)
        grad[f"u{d}"] = np.zeros_like(u)
        grad[f"c{d}"] = np.zeros(h_n, np.float32)
        dh = np.zeros((h_n, x.shape[1]), np.float32)
        one_hot, rows = np.zeros((256, x.shape[1]), np.float32), np.arange(x.shape[1])
        for t, h, z, r, q, n in reversed(saved):
            dh = dh + d_states[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * q * r * (1 - r)
            dq = dn * r
            to_u = np.concatenate([dz, dr, dq])
            grad[f"u{d}"] += h @ to_u.T
            grad[f"c{d}"] += dq.sum(axis=1)
            one_hot[x[t], rows] = 1
            grad[f"e{d}"] += one_hot @ np.concatenate([dz, dr, dn]).T
            one_hot[x[t], rows] = 0
            dh = dh * z + u @ to_u

    def gradient(self, x: np.ndarray, label: np.ndarray, mask: np.ndarray) -> dict:
        """Gradient of the mean cross-entropy of all real positions."""
        p, f, b, saved_f, saved_b = self.probabilities(x, keep=True)
        p[:, label, np.arange(x.shape[1])] -= 1
        p *= (mask / max(1.0, mask.sum()))[:, None, :].astype(np.float32)
        grad = {"of": np.einsum("thn,tkn->hk", f, p, optimize=True), "ob": np.einsum("thn,tkn->hk", b, p, optimize=True),
                "bias": p.sum(axis=(0, 2))}
        self._back(x, "f", saved_f, self.w["of"] @ p, grad)
        self._back(x, "b", saved_b, self.w["ob"] @ p, grad)
        return grad

    def fit(self, windows: np.ndarray, lengths: np.ndarray, label: np.ndarray, steps: int = STEPS, batch: int = BATCH,
            rate: float = RATE, seed: int = 11) -> "ByteGRU":
        """Adam over random batches with as many windows of each language."""
        rng = np.random.default_rng(seed)
        by_lang = [np.flatnonzero(label == k) for k in range(len(self.langs))]
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(rows, -(-batch // len(by_lang))) for rows in by_lang if len(rows)])
            x = windows[pick].T
            mask = np.arange(len(x))[:, None] < lengths[pick][None, :]
            now = rate * min(1.0, 2.0 * (1 - (step - 1) / steps))
            for k, g in self.gradient(x, label[pick], mask).items():
                np.clip(g, -1, 1, out=g)
                m[k] += 0.1 * (g - m[k])
                v2[k] += 0.01 * (g * g - v2[k])
                self.w[k] -= (now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return self


def windows_of(data: np.ndarray, off: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes (windows, size), real bytes of each, row of each): every byte of every row, in order."""
    lengths = np.diff(off)
    per_row = -(-lengths // size)
    row = np.repeat(np.arange(len(lengths)), per_row)
    at = (np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)) * size
    real = np.minimum(lengths[row] - at, size)
    place = (off[:-1][row] + at)[:, None] + np.arange(size)[None, :]
    held = np.arange(size)[None, :] < real[:, None]
    out = np.where(held, data[np.minimum(place, max(len(data) - 1, 0))], 32) if len(data) else np.zeros((0, size), np.uint8)
    return out.astype(np.uint8), real, row


def positions(model: ByteGRU, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each window, real bytes of each, probabilities (positions, languages, windows)), block by block."""
    data, off = byte_view(column)
    lengths = np.diff(off)
    lo = 0
    total = np.cumsum(-(-lengths // WINDOW))
    while lo < len(lengths):  # rows whose windows fill a block; a long row's windows go block by block
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + BLOCK, side="right")))
        a, b = int(off[lo]), int(off[hi])
        step = BLOCK * WINDOW
        cuts = range(a, b, step) if hi == lo + 1 and b - a > step else [a]
        for c in cuts:
            end = min(b, c + step) if len(cuts) > 1 else b
            local = np.array([0, end - c]) if len(cuts) > 1 else off[lo:hi + 1] - a
            x, real, row = windows_of(data[c:end], local)
            if len(row):
                yield row + lo, real, model.probabilities(np.ascontiguousarray(x.T))
        lo = hi


def sample_windows(labelled: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Bounded training sample: (languages, windows, real bytes, label) of rows (text, lang).

    The distinct texts with the smallest hash of each language; of each text up to WINDOWS_PER_DOC
    evenly spaced pieces of WINDOW characters.  A first pass estimates distinct texts per language (a
    sketch each); the next lets only hashes below a bound pass, so a language's sort sees a few times
    the sample however many texts it has.  Languages whose bound let too few texts through are taken
    again with a wider one, so the sample doesn't depend on the estimate.
    """
    known = labelled.where("text is not null and lang is not null and text != ''").select("lang", "text", F.xxhash64("text").alias("h"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    gap = F.greatest(F.lit(1), F.length("text") / F.lit(WINDOWS_PER_DOC)).cast("int")
    cut = F.array(*[F.substring(F.col("text"), F.lit(1) + gap * k, F.lit(WINDOW)) for k in range(WINDOWS_PER_DOC)])
    share = {r.lang: min(1.0, OVERSAMPLE * per_lang / max(r.n, 1))  # one row per language
             for r in known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    rows = []
    while share:
        top = F.lit(None).cast("long")
        for lang, part in share.items():
            top = F.when(F.col("lang") == lang, 2**63 - 1 if part >= 1 else int(part * 2**64) - 2**63).otherwise(top)
        got = (known.where(F.col("h") <= top).select("lang", "h", cut.alias("pieces")).groupBy("lang", "h").agg(F.first("pieces").alias("pieces"))
               .withColumn("rank", rank).where(F.col("rank") <= per_lang).collect())
        n = Counter(r.lang for r in got)
        again = {lang for lang, part in share.items() if part < 1 and n[lang] < per_lang}
        rows += [r for r in got if r.lang not in again]
        share = {lang: min(1.0, 8 * share[lang]) for lang in share if lang in again}
    rows.sort(key=lambda r: (r.lang, r.h))
    langs = sorted({r.lang for r in rows})
    pieces = [(p.encode()[:WINDOW], langs.index(r.lang)) for r in rows for p in r.pieces if p]
    x = np.full((len(pieces), WINDOW), 32, np.uint8)
    for i, (p, _) in enumerate(pieces):
        x[i, :len(p)] = np.frombuffer(p, np.uint8)
    return langs, x, np.array([len(p) for p, _ in pieces]), np.array([k for _, k in pieces])


def train(labelled: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> ByteGRU | None:
    """A model of the languages of ``labelled`` (text, lang), or None where no row has both."""
    langs, x, lengths, label = sample_windows(labelled, per_lang)
    return ByteGRU(langs).fit(x, lengths, label) if langs else None


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def with_language(docs: DataFrame, model: ByteGRU | None, keep: Callable | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, share.

    ``score`` is the pooled probability of ``lang_pred``, ``share`` the part of the positions
    labelled with it.  NULL text and text without a letter (and every text where there is no
    model) are ``und`` with score 0.  Equal texts get equal results; NULL and repeated doc_ids
    are carried through; other columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gru = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                lang, score, share = classify(gru, part.column("text"), part.column("letters"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lang, score, share],
                                                 names=["doc_id", "lang_pred", "score", "share"])

    return (docs.select("doc_id", "text", has_letter(F.col("text")).alias("letters"))
            .mapInArrow(run, "doc_id bigint, lang_pred string, score double, share double"))


def classify(model: ByteGRU | None, column: pa.Array, letters: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(language, pooled probability, share of positions with it) per row."""
    n, fits = len(column), np.asarray(letters.to_pylist(), bool)
    if model is None:
        return pa.array([UNKNOWN] * n), pa.array(np.zeros(n)), pa.array(np.zeros(n))
    pooled, votes = np.zeros((n, len(model.langs))), np.zeros((n, len(model.langs)))
    for row, real, p in positions(model, column):
        held = np.arange(len(p))[:, None] < real[None, :]
        p *= held[:, None, :]
        best = p.max(axis=1)
        for k in range(len(model.langs)):
            pooled[:, k] += np.bincount(row, weights=p[:, k].sum(axis=0), minlength=n)
            votes[:, k] += np.bincount(row, weights=((p[:, k] == best) & held).sum(axis=0), minlength=n)
    total = np.maximum(pooled.sum(axis=1), 1e-9)
    best = pooled.argmax(axis=1)
    at = np.arange(n)
    lang = [model.langs[b] if ok else UNKNOWN for b, ok in zip(best, fits)]
    return (pa.array(lang, pa.string()), pa.array(np.where(fits, np.clip(pooled[at, best] / total, 0, 1), 0.0)),
            pa.array(np.where(fits, votes[at, best] / np.maximum(votes.sum(axis=1), 1), 0.0)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def keep_known(docs: DataFrame, model: ByteGRU | None, least_score: float = 0.3) -> DataFrame:
    """``docs`` without the documents that the model rejects: ``und``, or a pooled probability below
    ``least_score``.  Same columns, rows untouched; without a model every document with a letter stays.
    NULL and empty texts go; equal rows stay or go together; ids aren't looked at; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    letters = "letters"
    while letters in docs.columns:
        letters += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lang, score, _ = classify(shared.value, part.column("text"), part.column(letters))
                fits = np.asarray(part.column(letters).to_pylist(), bool)
                stay = fits & (np.asarray(score) >= least_score) if shared.value is not None else fits
                yield part.drop_columns([letters]).filter(pa.array(stay))

    return docs.withColumn(letters, has_letter(F.col("text"))).mapInArrow(run, docs.schema)
