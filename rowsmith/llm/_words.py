"""Vectorised words over Arrow text batches.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Those bytes never
occur inside a multi-byte UTF-8 character, so working on bytes is exact. Spans
are hashed to 64 bits as polynomials of their bytes modulo 2**64, taken from
prefix sums, then mixed; cost is a few array operations a byte. Such hashes only
bring spans together: ``classes`` compares the bytes of those with equal hashes, and
``digests`` names words by keyed BLAKE2b where they are compared across texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
#: Bytes of text treated at once; a longer row is treated alone.
CHUNK = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """base**0, base**1, ... of at least ``n`` entries; one array per base, grown as needed."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        out = np.full(1 << max(16, (n - 1).bit_length()), base, U)
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def texts(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, bytes, offsets) of runs of rows of about ``limit`` bytes; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` that stay within a row: starts, ends (exclusive), rows."""
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = CHUNK) -> np.ndarray:
    """64-bit hashes of data[start:end]; spans in order of start. Memory follows ``block`` and the longest span."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + block, "right")))
        lo, hi = int(starts[i]), int(ends[i:j].max())
        size = hi - lo + 1
        part = np.zeros(hi - lo + 1, U)
        np.cumsum((data[lo:hi].astype(U) + U(1)) * _powers(size, BASE)[: hi - lo], out=part[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((part[e] - part[s]) * _powers(size, BASE_INV)[s] + U(0xD6E8FEB86659FD93) * (e - s).astype(U))
        i = j
    return out


def equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether data[a : a + size] == data[b : b + size], byte by byte, for each (not empty) pair."""
    same = np.ones(len(a), bool)
    long = np.flatnonzero(size > 1024)
    for i in long.tolist():
        same[i] = np.array_equal(data[a[i] : a[i] + size[i]], data[b[i] : b[i] + size[i]])
    live, k = np.flatnonzero(size <= 1024), 0
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    eight = lambda at: np.ascontiguousarray(view[at]).view("<u8")[:, 0]
    while len(live):
        rest = size[live] - k
        off = (eight(a[live] + k) ^ eight(b[live] + k)) << (8 * np.maximum(0, 8 - rest)).astype(U) != 0
        same[live[off]] = False
        live = live[~off & (rest > 8)]
        k += 8
    return same


def classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each (not empty) span, equal exactly where the bytes are; spans in order of start."""
    h, size = hash_spans(data, starts, ends), ends - starts
    order = np.argsort(h, kind="stable")
    new = np.ones(len(h), bool)
    tied = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    a, b = order[tied], order[tied + 1]
    alike = size[a] == size[b]
    alike[alike] = equal_spans(data, starts[a[alike]], starts[b[alike]], size[a[alike]])
    new[tied[alike] + 1] = False
    out = np.empty(len(h), np.int64)
    out[order] = np.cumsum(new) - 1
    if not alike.all():  # different spans with one hash: all spans of that hash are told apart by their bytes
        wrong = np.isin(h, np.unique(h[a[~alike]]))
        known: dict[bytes, int] = {}
        for i in np.flatnonzero(wrong).tolist():
            out[i] = known.setdefault(data[starts[i] : ends[i]].tobytes(), len(h) + len(known))
        _, out = np.unique(out, return_inverse=True)
    return out


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: bytes) -> np.ndarray:
    """128-bit keyed BLAKE2b digests of the spans, as two columns; each different span is hashed once."""
    number = classes(data, starts, ends)
    if not len(number):
        return np.zeros((0, 2), U)
    _, first = np.unique(number, return_index=True)
    raw, made = data.tobytes(), hashlib.blake2b
    named = b"".join([made(raw[s:e], digest_size=16, key=key).digest() for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
    return np.frombuffer(named, U).reshape(-1, 2)[number]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words."""
    return spans(~SPACE[data], offsets)


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n)
