"""Numpy kernels over the byte buffers of Arrow string columns, used inside Spark tasks.

A batch is cut into slices of about ``SLICE_BYTES`` (a longer text is a slice of its own), so memory
follows the longest text and not the batch. Hashes are 64 bits; two different words or texts out of n get
the same one with a chance of n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_STEP = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII that is neither a letter nor a digit.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(n: int) -> np.ndarray:
    out, p = np.empty(n, U64), 1
    for i in range(n):
        out[i] = p
        p = p * _BASE & _MASK
    return out


_POW = _powers(1 << 12)


def powers(n: int) -> np.ndarray:
    """The first n powers of the base; grown by doubling where a longer word comes."""
    global _POW
    while len(_POW) < n:
        _POW = np.concatenate([_POW, _POW * U64(pow(_BASE, len(_POW), 1 << 64))])
    return _POW[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers so that every output bit depends on every input bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(_STEP)
    x ^= x >> U64(29)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(32)
    return x


def text_slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and row offsets of consecutive slices; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1)
        yield at, to, raw[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


class Words:
    """Maximal runs of bytes that are no separators, in order: hash, text they belong to, place."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE):
        self.data, self.offsets, self.texts = data, offsets, len(offsets) - 1
        inside = ~separators[data]
        first = inside.copy()
        first[1:] &= separators[data[:-1]]
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[begins] = inside[begins]
        at = np.flatnonzero(inside)
        self.starts = np.flatnonzero(first)
        bounds = np.flatnonzero(first[at])
        self.lengths = np.diff(np.append(bounds, len(at)))
        self.bytes, self.bounds = LOWER[data[at]], bounds
        if len(at):
            place = np.arange(len(at)) - np.repeat(bounds, self.lengths)
            value = (self.bytes.astype(U64) + U64(1)) * powers(int(self.lengths.max()))[place]
            self.hashes = mix(np.add.reduceat(value, bounds))
        else:
            self.hashes = np.zeros(0, U64)
        self.text = np.searchsorted(offsets, self.starts, "right") - 1
        self.counts = np.bincount(self.text, minlength=self.texts)
        self.ends = np.cumsum(self.counts)


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words, and the text of each; a text of fewer words is one run, one of none has none."""
    h, doc = words.hashes, words.text
    p = powers(k + 1)
    runs, texts = np.zeros(0, U64), np.zeros(0, doc.dtype)
    if len(h) >= k:
        whole = doc[: len(h) - k + 1] == doc[k - 1 :]
        total = h[: len(h) - k + 1] * p[0]
        for j in range(1, k):
            total = total + h[j : len(h) - k + 1 + j] * p[j]
        runs, texts = mix(total[whole]), doc[: len(h) - k + 1][whole]
    few = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(few):
        begin = words.ends[few] - words.counts[few]
        total = np.zeros(len(few), U64)
        for j in range(k - 1):
            there = words.counts[few] > j
            total[there] += h[begin[there] + j] * p[j]
        runs = np.concatenate([runs, mix(total + words.counts[few].astype(U64))])
        texts = np.concatenate([texts, few])
    return runs, texts


def fingerprints(words: Words) -> np.ndarray:
    """One hash for each text's sequence of words; texts without words share one."""
    out = np.zeros(words.texts, U64)
    some = np.flatnonzero(words.counts)
    if len(some):
        begin = words.ends[some] - words.counts[some]
        place = np.arange(len(words.hashes)) - np.repeat(begin, words.counts[some])
        out[some] = np.add.reduceat(words.hashes * powers(int(words.counts.max()))[place], begin)
    return mix(out + words.counts.astype(U64))
