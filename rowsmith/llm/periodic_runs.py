"""Periodic runs of words: stretches that repeat with a period at least four times.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal), of length max(6, 4 q) or more, that no neighbouring word extends.

Main and Lorentz: a text is halved again and again. A run lies whole within some part
and across its middle; there, at least two of its periods lie on one side of the
middle. So the Z-function of the right half (how far the half agrees with itself moved
by p) is p or more at the run's period, or that of the reversed left half is. Each such
p that isn't a multiple of a period already seen at this middle is extended to both
sides within the part, and kept if it is long enough and neither neighbour in the text
continues it. Intervals are deduplicated with the smallest period.

Words are interned to numbers, and the middles of all parts of one size are looked at
together: only where the first two words of a side and two more repeat p words on is a
Z-function needed at all, and in prose that is nearly nowhere. These comparisons are
necessary conditions and leave out nothing.

Edge cases: null and empty texts have no words, no runs, and collapse to the empty text;
rows with one id, null ids and other columns are kept apart and passed over; a long text
takes time as n log n and memory in proportion. ``MIN_LENGTH`` and ``MIN_PERIODS`` are
the contract's; the halving argument needs four periods or more.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rowsmith.llm._io import small_batches

#: Fewest words of a run, and fewest periods.
MIN_LENGTH = 6
MIN_PERIODS = 4
#: Words looked at together; a longer text is looked at alone.
TOGETHER = 1 << 18

Run = tuple[int, int, int]


def z_function(s: list[int]) -> list[int]:
    """For each place of ``s``, how many words from there on agree with the beginning."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many first entries of a and b agree, looked at in growing pieces."""
    done, size = 0, 16
    while done < len(a):
        wrong = np.flatnonzero(a[done : done + size] != b[done : done + size])
        if len(wrong):
            return done + int(wrong[0])
        done, size = done + size, 2 * size
    return len(a)


def _periods(half: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(p, z) for each p up to ``most`` at which the half, read away from the middle, begins with two or more periods."""
    z = z_function(half.tolist())
    return [(p, z[p]) for p in range(1, min(most, len(z) - 1) + 1) if z[p] >= p]


def _crossing(s: np.ndarray, lo: int, mid: int, hi: int, right: bool, left: bool) -> Iterator[Run]:
    """(start, end, period) of the repetitions across ``mid`` within s[lo:hi], none a multiple of another's period."""
    most = (hi - lo) // MIN_PERIODS
    for wanted, forward in ((right, True), (left, False)):
        seen: list[tuple[int, int]] = []
        for p, z in _periods(s[mid:hi] if forward else s[lo:mid][::-1], most) if wanted else ():
            first, last = (mid, mid + 2 * p) if forward else (mid - 2 * p, mid)
            if any(a <= first and last <= b for a, b in seen):
                continue
            if forward:
                b = mid + p + z
                back = s[lo:mid][::-1]
                a = mid - _agreeing(back, s[lo + p : mid + p][::-1])
            else:
                a = mid - p - z
                b = mid + _agreeing(s[mid:hi], s[mid - p : hi - p])
            seen.append((a, b))
            yield a, b, p


def _suspects(s: np.ndarray, pair: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part, whether its right or its left half may begin, at the middle, with two periods."""
    mid, most = (lo + hi) // 2, (hi - lo) // MIN_PERIODS
    part = np.repeat(np.arange(len(lo)), most)
    p = np.arange(len(part)) - np.repeat(np.cumsum(most) - most, most) + 1
    m = mid[part]
    out = []
    for forward in (True, False):
        there = np.flatnonzero(pair[m] == pair[m + p] if forward else pair[m - 2] == pair[m - 2 - p])
        q, at = p[there], m[there]
        half = q // 2
        if forward:
            there = there[(s[at + q - 1] == s[at + 2 * q - 1]) & (s[at + half] == s[at + half + q])]
        else:
            there = there[(s[at - q] == s[at - 2 * q]) & (s[at - 1 - half] == s[at - 1 - half - q])]
        out.append(np.bincount(part[there], minlength=len(lo)) > 0)
    return out[0], out[1]


def all_runs(s: np.ndarray, offsets: np.ndarray) -> list[list[Run]]:
    """For each text s[offsets[k]:offsets[k + 1]] of numbers its runs (start, length, period) by start, then period."""
    found: list[dict[tuple[int, int], int]] = [{} for _ in range(len(offsets) - 1)]
    text = np.arange(len(offsets) - 1)
    lo, hi = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    pair = (s[:-1].astype(np.int64) << 32) | s[1:] if len(s) else s
    while True:
        long = hi - lo >= MIN_LENGTH
        text, lo, hi = text[long], lo[long], hi[long]
        if not len(lo):
            break
        mid = (lo + hi) // 2
        right, left = _suspects(s, pair, lo, hi)
        for k in np.flatnonzero(right | left).tolist():
            t, (begin, end) = int(text[k]), offsets[text[k] : text[k] + 2].tolist()
            for a, b, p in _crossing(s, int(lo[k]), int(mid[k]), int(hi[k]), bool(right[k]), bool(left[k])):
                if b - a < max(MIN_LENGTH, MIN_PERIODS * p) or (a > begin and s[a - 1] == s[a - 1 + p]) or (b < end and s[b] == s[b - p]):
                    continue
                key = (a - begin, b - a)
                found[t][key] = min(p, found[t].get(key, p))
        text, lo, hi = np.concatenate([text, text]), np.concatenate([lo, mid]), np.concatenate([mid, hi])
    return [sorted(((a, n, p) for (a, n), p in f.items()), key=lambda r: (r[0], r[2])) for f in found]


def best_run(runs: list[Run]) -> Run | None:
    """The run of the greatest exact length / period; of ties the smallest start, then period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if runs:
        stays = np.ones(len(words), bool)
        for start, length, period in runs:
            stays[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(stays).tolist()]
    return b" ".join(words)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with the repetition that the contract's rule plants in one document of ten; none where the id is null."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def _texts(batch: pa.RecordBatch, prepare: Callable | None) -> Iterator[tuple[list[list[bytes]], list[list[Run]]]]:
    """Words and runs of a batch's texts (columns doc_id, text), some texts at a time, in order."""
    words: list[list[bytes]] = []

    def flush():
        number: dict[bytes, int] = {}
        intern = [number.setdefault(w, len(number)) for ws in words for w in ws]
        offsets = np.concatenate([[0], np.cumsum([len(ws) for ws in words])]).astype(np.int64)
        return list(words), all_runs(np.array(intern, np.int32), offsets)

    held = 0
    for doc_id, t in zip(batch.column(0), batch.column(1).cast(pa.large_binary()), strict=True):
        # Splitting bytes cuts at 0x20 and 0x09-0x0D, which no other character's bytes contain.
        ws = (t.as_py() or b"").split()
        words.append(prepare(doc_id.as_py(), ws) if prepare else ws)
        held += len(ws)
        if held >= TOGETHER:
            yield flush()
            words.clear()
            held = 0
    if words:
        yield flush()


def _mapped(docs: DataFrame, schema: str, kinds: list[pa.DataType], row: Callable, prepare: Callable | None) -> DataFrame:
    """``row(doc_id, words, runs)``, a list of rows, of each text."""
    small_batches(docs.sparkSession)
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column(0).to_pylist(), 0
            for words, runs in _texts(batch, prepare):
                out = [r for i, w, f in zip(ids[at : at + len(words)], words, runs, strict=True) for r in row(i, w, f)]
                at += len(words)
                columns = zip(*out, strict=True) if out else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def find_runs(docs: DataFrame, prepare: Callable | None = None) -> DataFrame:
    """One row per run of each text of ``docs`` (doc_id, text): doc_id, start, length, period, exponent_milli, in words."""

    def row(doc_id, words, runs):
        return [(doc_id, a, n, p, 1000 * n // p) for a, n, p in runs]

    return _mapped(docs, "doc_id long, start long, length long, period long, exponent_milli long", [pa.int64()] * 5, row, prepare)


def collapse_runs(docs: DataFrame, prepare: Callable | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_runs and the text with each run cut to its first period, words joined by one space."""

    def row(doc_id, words, runs):
        return [(doc_id, len(runs), collapsed(words, runs).decode())]

    return _mapped(docs, "doc_id long, n_runs long, text string", [pa.int64(), pa.int64(), pa.string()], row, prepare)


def summaries(docs: DataFrame, prepare: Callable | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_runs, the best run, and SHA-256 digests of all runs and of the collapsed text."""
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"

    def row(doc_id, words, runs):
        start, length, period = best_run(runs) or (None, None, None)
        lines = "".join(f"{a},{n},{p}\n" for a, n, p in runs)
        exponent = 1000 * length // period if runs else None
        return [(doc_id, len(runs), start, length, period, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest())]

    return _mapped(docs, schema, [pa.int64()] * 6 + [pa.string()] * 2, row, prepare)
