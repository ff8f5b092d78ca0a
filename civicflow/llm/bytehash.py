"""Vectorised words and 64-bit hashes of byte ranges.

Words are maximal runs of "word" bytes.  A word is hashed eight bytes at a time: each block is
added to the state by exclusive or, and the state is scrambled by multiplications and shifts, so
the result is no linear function of the bytes and no family of texts collides by its structure.  All words of a slice
take their first block together, then those that have a second one, and so on; the few long words are hashed one by one.
Hashes are 64 bits wide and the same in every task and every run; another seed gives an independent hash.
Where two different sequences of the whole corpus must never be taken for one, two of them are used.
"""

from __future__ import annotations

import numpy as np
import xxhash

_LONG = 64           # bytes; longer words are rare
_WORDS_AT_ONCE = 1 << 17
_BLOCK, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection with good avalanche)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None, seed: int = 0) -> np.ndarray:
    """Hash of data[start:end] for each range; ``fold`` maps bytes first (e.g. to lower case)."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    if fold is not None:
        data = fold[data]
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    blocks = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))  # the eight bytes from each position on
    start_state = mix(np.array([seed + 1], np.uint64))[0]
    for lo in range(0, len(starts), _WORDS_AT_ONCE):
        at, size = starts[lo:lo + _WORDS_AT_ONCE].astype(np.int64), (ends - starts)[lo:lo + _WORDS_AT_ONCE].astype(np.int64)
        h = start_state ^ (size.astype(np.uint64) * _BLOCK)
        some = np.flatnonzero((size > 0) & (size <= _LONG))
        for k in range(0, _LONG, 8):
            some = some[size[some] > k]
            if not len(some):
                break
            block, rest = blocks[at[some] + k], size[some] - k
            part = np.flatnonzero(rest < 8)
            block[part] &= (np.uint64(1) << (rest[part] * 8).astype(np.uint64)) - np.uint64(1)
            h[some] = _scrambled(h[some] ^ block)
        for i in np.flatnonzero(size > _LONG).tolist():
            h[i] = xxhash.xxh3_64_intdigest(padded[at[i]:at[i] + size[i]].data, seed)
        out[lo:lo + _WORDS_AT_ONCE] = mix(h)
    return out


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = h * _BLOCK
    h ^= h >> np.uint64(32)
    h *= _STEP
    h ^= h >> np.uint64(29)
    return h


def sequence_hashes(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` word hashes from each place on; the shift keeps it from being linear in the words."""
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        h ^= h >> np.uint64(29)
        h *= _STEP
        h += words[at + k]
    return mix(h)


def byte_class(members: str | bytes) -> np.ndarray:
    """256 booleans: True for the listed byte values."""
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = byte_class(b" \t\n\x0b\x0c\r")
NOT_SPACE = ~SPACES
ALNUM = byte_class(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | (np.arange(256) >= 128)


def word_ranges(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words per row): rows are data[off[i]:off[i+1]]; no word crosses rows."""
    n_rows = len(off) - 1
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(n_rows, np.int64)
    w = is_word[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = w[:-1]
    starts = np.flatnonzero(w & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = w[1:]
    ends = np.flatnonzero(w & (~after | first[1:])) + 1
    counts = np.diff(np.searchsorted(starts, off))
    return starts, ends, counts


def gram_hashes(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of every run of ``n`` consecutive words of a row.

    Returns (hash, row, start word within the row), rows in order.
    """
    per_row = np.maximum(counts - n + 1, 0)
    total = int(per_row.sum())
    row = np.repeat(np.arange(len(counts)), per_row)
    start = np.arange(total) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    at = np.repeat(np.cumsum(counts) - counts, per_row) + start
    return sequence_hashes(words, at, n), row, start
