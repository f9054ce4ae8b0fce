"""Words, spans and shingles of many texts at once, in numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D, which in
UTF-8 is the same as the code-point pattern ``[^\\x20\\x09-\\x0D]+``.  Hashes are
64-bit; memory is bounded by the slice of texts handled at a time, plus the
longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_LEN = U(0xD6E8FEB86659FD93)
_CHUNK = 1 << 17
SLICE_BYTES = 1 << 20

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U), np.ones(1, U))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n + 1:
        size = max(n + 1, _CHUNK + 1)
        tables = []
        for base in (_P, _PINV):
            t = np.full(size, U(base))
            t[0] = 1
            tables.append(np.cumprod(t, dtype=U))
        if size > 4 * _CHUNK:  # a single very long span: do not keep it
            return tables[0], tables[1]
        _powers = (tables[0], tables[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for ascending, non-overlapping spans."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(int(np.searchsorted(ends, lo + _CHUNK, "right")), i + 1)
        hi = int(ends[j - 1])
        power, inverse = _power_tables(hi - lo)
        sums = np.zeros(hi - lo + 1, U)
        np.cumsum((values[lo:hi].astype(U) + U(1)) * power[: hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * inverse[s]
        i = j
    return mix(out + (ends - starts).astype(U) * _LEN)


@dataclass
class Texts:
    """A slice of texts as one byte buffer; text r is buf[offsets[r]:offsets[r+1]]."""

    first: int
    buf: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all words."""
        n = len(self.buf)
        if n == 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        sep = separator[self.buf]
        bounds = self.offsets
        before = np.empty(n, bool)
        before[0], before[1:] = True, sep[:-1]
        before[bounds[bounds < n]] = True
        after = np.empty(n, bool)
        after[-1], after[:-1] = True, sep[1:]
        after[bounds[bounds > 0] - 1] = True
        return np.flatnonzero(~sep & before), np.flatnonzero(~sep & after) + 1

    def row_of(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, starts, "right") - 1

    def per_row(self, mask: np.ndarray) -> np.ndarray:
        """How many set bytes each text has."""
        total = np.zeros(len(self.buf) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def line_spans(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the \\n-split lines of all texts, in order."""
    breaks = np.flatnonzero(texts.buf == 0x0A)
    starts = np.sort(np.concatenate([texts.offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([texts.offsets[1:], breaks]), kind="stable")
    return starts, ends


def text_slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cut a string column (null: empty) into slices of about ``max_bytes``."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, np.int64)[column.offset: column.offset + n + 1]
    everything = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1, i + 1)
        yield Texts(i, everything[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
        i = j


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """First index of each row's items in the ascending ``rows``, and the end."""
    return np.searchsorted(rows, np.arange(n + 1))


def shingle_sets(texts: Texts, k: int = 5) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct hashes of its k-word shingles (A-Z
    lower-cased); the whole sequence if it has fewer words, nothing if none."""
    texts = Texts(texts.first, LOWER[texts.buf], texts.offsets)
    starts, ends = texts.words()
    hashes = span_hashes(texts.buf, starts, ends)
    bounds = row_bounds(texts.row_of(starts), len(texts))
    for r in range(len(texts)):
        w = hashes[bounds[r]: bounds[r + 1]]
        if len(w) == 0:
            yield w
        elif len(w) < k:
            yield span_hashes(w, np.array([0]), np.array([len(w)]))
        else:
            n = len(w) - k + 1
            acc = w[:n].copy()
            for j in range(1, k):
                acc = acc * U(_P) + w[j: j + n]
            yield np.unique(mix(acc + U(k * int(_LEN) % (1 << 64))))
