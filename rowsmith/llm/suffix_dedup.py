"""Removal of repeated byte strings with suffix arrays of shards.

Every byte covered by a string of ``LENGTH`` bytes that starts anywhere else, too, goes.

1. Anchors: the anchor of a LENGTH-byte string is its ``GRAM``-byte gram with the smallest
   hash, the first of equal ones. Equal strings have equal anchors at equal places, so a
   repeated string stands around an anchor that is repeated.
2. Anchors are counted over all texts; those that occur once are done with. The texts
   that have others are kept with the places of their repeated anchors.
3. The window of an anchor holds the strings that have their anchor there: each string is
   in one window only. Equal windows of an anchor are told by digest and
   counted; a window that occurs twice is repeated as a whole. Of an anchor with
   different windows one copy of each is fetched.
4. All such windows of an anchor come to one task, which handles about ``STREAM`` bytes at a
   time. They are concatenated, and the suffix array and permuted common prefixes of the whole
   tell which strings stand at two places. Where more than ``SORTED`` windows meet, they are first
   halved by the side of the anchor that strings start on, again and again, and told apart by the bytes that all
   strings of a half share: a half that no other window has can hold no repeated string, and
   halves of equal bytes are repeated as a whole.
5. The spans found go back to all texts with that window, are united, and removed.

Anchors and windows are dealt by hash after counts have been added up on the map side.
An anchor with more than
``SPLIT`` different windows is not gathered: its windows are halved by the side of the
anchor that strings start on and told apart by the context that all those strings share,
again and again, until groups are small; nothing is left out by that.

Texts are known by 16 bytes of their SHA-256, so equal texts share all work.

Edge cases: null texts are empty; texts shorter than LENGTH have no spans; repeated rows
are equal texts and lose whatever is long enough; null ids and other columns don't
matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm._io import bucketed, materialize, small_batches
from rowsmith.llm._words import BASE, BASE_INV, U, _powers, equal_spans, mix, texts
from rowsmith.llm.suffix_array import permuted_common_prefixes, suffix_array

LENGTH = 200
#: Key of the windows' digests. Whoever writes the texts may not know it in a deployment that fears forged collisions.
KEY = b"rowsmith windows"
GRAM = 96
#: Bytes of one suffix array, and of windows printed at once.
SHARD = 1 << 20
#: Bytes of a very long text whose anchors are found at once.
BLOCK = 1 << 22
#: Bytes of windows taken from the stream at a time.
STREAM = 1 << 22
#: Bytes of texts whose anchors are found at once.
CHUNK = 1 << 19
#: Windows or halves that agree in the bytes all their strings share up to which their suffixes are sorted together.
SORTED = 512
#: Different windows of one anchor up to which they are gathered.
SPLIT = 1 << 16


_ONE_UP = np.arange(1, 257, dtype=np.uint64)


# ---------------------------------------------------------------- anchors
def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of each gram-byte string of data: polynomials of its bytes, from prefix sums. They only choose and group anchors."""
    size = len(data) + 1
    sums = np.zeros(size, U)
    np.cumsum(_ONE_UP[data] * _powers(size, BASE)[: len(data)], out=sums[1:])
    return (sums[gram:] - sums[:-gram]) * _powers(size, BASE_INV)[: size - gram]


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best of x[i : i + width] for each i with a full window."""
    out, size = x, 1
    while 2 * size <= width:
        out = best(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return best(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of a run of texts' anchors the rows, places (in ``data``) and hashes, and how far before the place the first and
    the last string starts that has its anchor there."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return (none,) * 5
    if len(offsets) == 2 and len(data) > 2 * BLOCK:  # one very long text: blocks with all that decides about their grams
        found = []
        for begin in range(0, len(data), BLOCK):
            base = max(0, begin - length)
            piece = data[base : begin + BLOCK + length]
            _, at, *more = anchors(piece, np.array([0, len(piece)]), length, gram)
            mine = (at + base >= begin) & (at + base < begin + BLOCK)
            found.append((at[mine] + base, *(x[mine] for x in more)))
        found = [np.concatenate(x) for x in zip(*found, strict=True)]
        return np.zeros(len(found[0]), np.int64), *found
    h = _gram_hashes(data, gram)
    low = ((h ^ (h >> U(29))) * U(0x9E3779B97F4A7C15)) >> U(32)
    # The smallest hash, and of equal ones the first, of each string's grams. From string to string it stays or moves on.
    first = (_sliding((low << U(32)) | np.arange(len(low), dtype=U), length - gram + 1, np.minimum) & U(0xFFFFFFFF)).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    start = np.flatnonzero(np.arange(len(first)) + length <= ends[: len(first)])
    if not len(start):
        return (none,) * 5
    place = first[start]
    begun = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.append(begun[1:], len(place)) - 1
    at = place[begun]
    return np.searchsorted(offsets, at, "right") - 1, at, mix(h[at]).view(np.int64), at - start[begun], at - start[last]


def _keys(column: pa.Array) -> list[bytes]:
    return [hashlib.sha256((t.as_py() or "").encode()).digest()[:16] for t in column]


def _anchor_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, data, offsets in texts(batch.column(0), CHUNK):
            row, place, h, before, until = anchors(data, offsets)
            keys = pa.array(_keys(batch.column(0).slice(at, len(offsets) - 1)), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(h), keys.take(pa.array(row)), *[pa.array(x.astype(np.int32)) for x in (place - offsets[row], before * 256 + until)]], names=["anchor", "key", "place", "reach"])


# ---------------------------------------------------------------- windows
def _digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """128-bit keyed BLAKE2b digests, as two columns, of data[start:end] and of the place ``at`` in it."""
    raw = data.tobytes()
    made = (hashlib.blake2b(raw[s:e], digest_size=16, key=KEY, salt=k.to_bytes(8, "little")).digest() for s, e, k in zip(starts.tolist(), ends.tolist(), at.tolist(), strict=True))
    return np.frombuffer(b"".join(made), np.int64).reshape(-1, 2)


def _places(batch: pa.RecordBatch, at: int, offsets: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and values of a list column for the texts from ``at`` on."""
    part = batch.column(lists).slice(at, len(offsets) - 1)
    rows = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy(zero_copy_only=False))
    return rows, part.flatten()


def _window_rows(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Of (key, copies, text, anchors, places, reaches): the windows, each with its digests."""
    for batch in batches:
        for at, data, offsets in texts(batch.column(2)):
            row, anchor = _places(batch, at, offsets, 3)
            place, reach = (_places(batch, at, offsets, i)[1].to_numpy(zero_copy_only=False).astype(np.int64) for i in (4, 5))
            order = np.lexsort((place, row))
            row, place, reach, anchor = row[order], place[order], reach[order], anchor.take(pa.array(order))
            begin, before, until = offsets[row], reach // 256, reach % 256
            lo, hi = begin + place - before, begin + place - until + length
            d1, d2 = _digests(data, lo, hi, before).T
            take = pa.array(row + at)
            small = [pa.array(x.astype(np.int32)) for x in (place, lo - begin, hi - begin)]
            yield pa.RecordBatch.from_arrays([anchor, pa.array(d1.copy()), pa.array(d2.copy()), batch.column(0).take(take), batch.column(1).take(take), *small], names=["anchor", "d1", "d2", "key", "copies", "place", "lo", "hi"])


_WINDOW = "anchor long, d1 long, d2 long, key binary, copies long, place int, lo int, hi int"


def _cut(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """data[start:stop] of each pair as a binary array."""
    size = stop - start
    offs = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(offs[-1]) + np.repeat(start - offs[:-1], size)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(data[index])])


def _fetched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (key, text, wanted windows): one row a window, with its bytes."""
    for batch in batches:
        for at, data, offsets in texts(batch.column(1)):
            row, wanted = _places(batch, at, offsets, 2)
            number = lambda f, w=wanted: w.field(f).to_numpy(zero_copy_only=False).astype(np.int64)
            lo, hi, n, place = number("lo"), number("hi"), number("n"), number("place")
            for k in range(0, len(row), 4096):
                s = slice(k, k + 4096)
                start = offsets[row[s]]
                columns = [wanted.field("anchor")[s], batch.column(0).take(pa.array(row[s] + at)), pa.array(lo[s].astype(np.int32)), pa.array((place[s] - lo[s]).astype(np.int32)), pa.array(n[s] > 1), _cut(data, start + lo[s], start + hi[s])]
                yield pa.RecordBatch.from_arrays(columns, names=["group", "key", "lo", "at", "many", "window"])


_CONTENT = "group long, key binary, lo int, at int, many boolean, window binary"
_SPAN = "key binary, a int, b int"


def repeated_starts(windows: list[bytes], many: np.ndarray, owner: np.ndarray, begin: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Window numbers and places in them of the ``length``-byte strings that stand at two places.

    many: the window occurs more than once; owner, begin: whose text it is and where it begins there."""
    size = np.fromiter((len(w) for w in windows), np.int64, len(windows))
    data = np.frombuffer(b"".join(windows), np.uint8)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    # Each window is followed by a separator, smaller than all bytes; the whole by the end mark.
    number = np.repeat(np.arange(len(windows)), size)
    text = np.ones(len(data) + len(windows) + 1, np.int64)
    at = np.arange(len(data)) + number
    text[at] = data.astype(np.int64) + 2
    text[-1] = 0
    sa = suffix_array(text, 258)
    back = np.full(len(text), -1, np.int64)
    off = np.arange(len(data)) - first[number]
    whole = off + length <= size[number]
    back[at[whole]] = np.flatnonzero(whole)
    order = back[sa]
    order = order[order >= 0]
    if not len(order):
        return order, order
    # A separator differs from every byte, so strings with a common prefix of this length are neighbours in the array.
    plcp = permuted_common_prefixes(text, sa)
    run = np.flatnonzero(plcp[at[order]] < length)
    count = np.diff(np.append(run, len(order)))
    w = number[order]
    where = (owner[w] << 32) | (begin[w] + off[order])
    two = (np.minimum.reduceat(where, run) != np.maximum.reduceat(where, run)) | np.maximum.reduceat(many[w], run)
    found = np.zeros(len(data), bool)
    found[order] = np.repeat(two, count)
    found = np.flatnonzero(found)
    return number[found], off[found]


def _merged(w: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans united inside each window: touching or overlapping ones become one."""
    order = np.lexsort((lo, w))
    w, lo, hi = w[order], lo[order], hi[order]
    base = w * (1 << 33)
    reach = np.maximum.accumulate(base + hi)
    new = np.ones(len(w), bool)
    new[1:] = base[1:] + lo[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(w)) - 1
    return w[first], lo[first], reach[last] - base[first]


class _Prints:
    """Fingerprints of parts of one byte array, each in constant time. They only bring parts together: equal
    prints are followed by comparing bytes."""

    def __init__(self, data: np.ndarray):
        size = len(data) + 1
        self.down = _powers(size, BASE_INV)
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(_ONE_UP[data] * _powers(size, BASE)[: len(data)])])

    def of(self, start: np.ndarray, stop: np.ndarray, salt: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start] + salt)


def _parts(data: np.ndarray, first: np.ndarray, size: np.ndarray, group: np.ndarray, at: np.ndarray, part: tuple[np.ndarray, ...], length: int) -> tuple[np.ndarray, ...]:
    """Of parts (window, starts from al to be, sure): the same and begin, end, prints of the shared bytes and of the whole.

    Parts without any start drop out. Windows are printed about a megabyte at a time, however large their group is."""
    out, spare, w = [], length - GRAM, part[0]
    cut = [*np.searchsorted(first[w], np.arange(0, len(data) + 1, SHARD)).tolist(), len(w)]
    for lo, hi in zip(cut[:-1], cut[1:], strict=True):
        x, al, be, sure = (c[lo:hi] for c in part)
        begin, end = np.maximum(0, at[x] - spare + al), np.minimum(size[x], at[x] - spare + be - 1 + length)
        ok = end - begin >= length
        if not ok.any():
            continue
        x, al, be, sure, begin, end = (c[ok] for c in (x, al, be, sure, begin, end))
        base = first[x[0]]
        prints = _Prints(data[base : first[x[-1]] + size[x[-1]]])
        here = first[x] - base
        core = prints.of(here + at[x] - spare + be - 1, here + at[x] - spare + al + length, mix(group[x].view(U) + al.astype(U) * U(256) + be.astype(U)))
        out.append((x, al, be, sure, begin, end, core, prints.of(here + begin, here + end, mix(core + (at[x] - begin).astype(U) * U(512) + (end - begin).astype(U)))))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (w[:0],) * 8


def _equal_parts(data: np.ndarray, window: np.ndarray, start: np.ndarray, stop: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, ...]:
    """Like np.unique of ``prints`` (values, first places, inverse, counts), but of parts with one print only those
    of the same bytes count as equal. Parts stand in order of window and start; overlapping ones of one window that
    are to equal parts of one other window at the same distance are compared as one."""
    _, one, of = np.unique(prints, return_index=True, return_inverse=True)
    other, size = np.flatnonzero(one[of] != np.arange(len(of))), stop - start
    rep = one[of[other]]
    alike = size[other] == size[rep]
    x, y = other[alike], rep[alike]
    if len(x):
        apart = np.ones(len(x), bool)
        apart[1:] = (window[x][1:] != window[x][:-1]) | (window[y][1:] != window[y][:-1]) | ((start[x] - start[y])[1:] != (start[x] - start[y])[:-1]) | (start[x][1:] > stop[x][:-1]) | (start[x][1:] < start[x][:-1])
        first = np.flatnonzero(apart)
        end = np.maximum.reduceat(stop[x], first)
        same = np.repeat(equal_spans(data, start[x[first]], start[y[first]], end - start[x[first]]), np.diff(np.append(first, len(x))))
        some = ~same
        same[some] = equal_spans(data, start[x[some]], start[y[some]], size[x[some]])
        alike[alike] = same
    if not alike.all():
        odd, known = other[~alike], {}
        of = of.copy()
        of[odd] = [known.setdefault((of[i], data[start[i] : stop[i]].tobytes()), len(one) + len(known)) for i in odd.tolist()]
    return np.unique(of, return_index=True, return_inverse=True, return_counts=True)


def _runs(core: np.ndarray, size: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Places of whole groups of equal ``core``, about ``most`` bytes at a time."""
    order = np.argsort(core, kind="stable")
    new = np.concatenate([[True], core[order][1:] != core[order][:-1]])
    before = np.concatenate([[0], np.cumsum(size[order])[:-1]])
    shard = np.maximum.accumulate(np.where(new, before // most, 0))
    yield from np.split(order, np.flatnonzero(np.diff(shard)) + 1)


def _shard(rows: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    """The repeated spans of some anchors' windows. Windows known to be repeated as a whole are only partners here."""
    column = lambda c: rows.column(c).combine_chunks()
    window = column("window").cast(pa.large_binary())
    offs = np.frombuffer(window.buffers()[1], np.int64, len(window) + 1, window.offset * 8)
    data = np.frombuffer(window.buffers()[2], np.uint8)[offs[0] : offs[-1]]
    first, size = offs[:-1] - offs[0], np.diff(offs)
    group, at, many, lo = (column(c).to_numpy(zero_copy_only=False) for c in ("group", "at", "many", "lo"))
    owner = column("key").dictionary_encode().indices.to_numpy().astype(np.int64)
    at, lo, n = at.astype(np.int64), lo.astype(np.int64), len(size)
    part = (np.arange(n), np.zeros(n, np.int64), np.full(n, length - GRAM + 1), many)
    spans = []
    while len(part[0]):
        w, al, be, sure, begin, end, core, whole = _parts(data, first, size, group, at, part, length)
        if not len(w):
            break
        _, of, count = np.unique(core, return_inverse=True, return_counts=True)
        w, al, be, sure, begin, end, core, whole = (x[count[of] > 1] for x in (w, al, be, sure, begin, end, core, whole))
        # Equal parts are repeated as a whole; one of them stays as a partner of unequal ones.
        _, one, of, count = _equal_parts(data, w, first[w] + begin, first[w] + end, whole)
        known = count > 1
        np.logical_or.at(known, of, sure)
        x = np.flatnonzero(known[of] & ~sure) if len(of) else of
        spans.append((w[x], begin[x], end[x]))
        # Parts that agree in the middle and differ at the ends are sorted by suffix; where very many do, halved first.
        _, cof, kinds = np.unique(core[one], return_inverse=True, return_counts=True)
        few, crowd = (np.flatnonzero(m) for m in ((kinds[cof] > 1) & (kinds[cof] <= SORTED), kinds[cof] > SORTED))
        for k in _runs(core[one[few]], end[one[few]] - begin[one[few]], SHARD) if len(few) else ():
            pick, sure_ = one[few[k]], known[few[k]]
            start, stop = first[w[pick]] + begin[pick], first[w[pick]] + end[pick]
            found, off = repeated_starts([data[a:b].tobytes() for a, b in zip(start.tolist(), stop.tolist(), strict=True)], sure_, owner[w[pick]], lo[w[pick]] + begin[pick], length)
            found, off = found[~sure_[found]], off[~sure_[found]]
            spans.append((w[pick][found], begin[pick][found] + off, begin[pick][found] + off + length))
        c = one[crowd]
        mid = (al[c] + be[c]) // 2
        part = (np.concatenate([w[c], w[c]]), np.concatenate([al[c], mid]), np.concatenate([mid, be[c]]), np.concatenate([known[crowd]] * 2))
        order = np.argsort(part[0], kind="stable")
        part = tuple(x[order] for x in part)
        keep = part[1] < part[2]
        part = tuple(x[keep] for x in part)
    if not spans or not sum(len(x[0]) for x in spans):
        return
    sw, sa, sb = _merged(*(np.concatenate(x) for x in zip(*spans, strict=True)))
    yield pa.RecordBatch.from_arrays([rows.column("key").take(pa.array(sw)).combine_chunks(), pa.array((lo[sw] + sa).astype(np.int32)), pa.array((lo[sw] + sb).astype(np.int32))], names=["key", "a", "b"])


def _sorted_shards(batches: Iterable[pa.RecordBatch], length: int, size: int) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over whole groups, about ``size`` bytes at a time."""
    held: list[pa.RecordBatch] = []
    held_bytes, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        g = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), batch.num_rows]
        begun = 0
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if g[lo] != last and held_bytes >= size:
                if lo > begun:
                    held.append(batch.slice(begun, lo - begun))
                yield from _shard(pa.Table.from_batches(held), length)
                held, held_bytes, begun = [], 0, lo
            last = g[lo]
            held_bytes += (hi - lo) * (2 * length - GRAM)
        held.append(batch.slice(begun))
    if held:
        yield from _shard(pa.Table.from_batches(held), length)


def _cleaned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (key, text, spans): key, spans removed, and what is left."""
    for batch in batches:
        keys, removed, number, kept, united = [], [], [], [], []
        for i in range(batch.num_rows):
            data = batch.column(1)[i].as_py().encode()
            pieces, at, gone, runs, bounds = [], 0, 0, 0, []
            for s in sorted(batch.column(2)[i].as_py(), key=lambda s: s["a"]):
                if s["a"] > at or not runs:
                    pieces.append(data[at : s["a"]])
                    runs += 1
                    bounds.append([s["a"], s["b"]])
                    gone += s["b"] - s["a"]
                    at = s["b"]
                elif s["b"] > at:
                    gone += s["b"] - at
                    at = bounds[-1][1] = s["b"]
            pieces.append(data[at:])
            keys.append(batch.column(0)[i].as_py())
            removed.append(gone)
            number.append(runs)
            kept.append(b"".join(pieces))
            united.append([{"a": a, "b": b} for a, b in bounds])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(removed, pa.int64()), pa.array(number, pa.int64()), pa.array(united, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))), pa.array(kept, pa.binary())], names=["key", "n_removed", "n_spans", "removed", "kept"])


# ---------------------------------------------------------------- the operator
def _text_key(text: str = "text"):
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _halved(rows: DataFrame, split: int) -> tuple[DataFrame, DataFrame]:
    """Windows of crowded anchors, regrouped until groups are small: (small groups' windows, spans found on the way).

    A window stands for the strings that start ``al`` to ``be`` - 1 bytes after the first place
    that reaches its anchor. Halving that range leaves bytes that all strings of a half
    share; windows that differ there have no string in common and part. Windows that become
    equal are repeated as a whole, and one of them goes on as a partner."""
    spare = LENGTH - GRAM
    live = rows.withColumns({"al": F.lit(0), "be": F.lit(spare + 1)})
    small = spans = None
    while True:
        mid = F.floor((F.col("al") + F.col("be")) / 2).cast("int")
        halves = F.array(F.struct(F.col("al").alias("al"), mid.alias("be")), F.struct(mid.alias("al"), F.col("be").alias("be")))
        each = live.withColumn("half", F.explode(halves)).withColumns({"al": F.col("half.al"), "be": F.col("half.be")}).drop("half").where("al < be")
        begin = F.greatest(F.lit(0), F.col("at") - spare + F.col("al"))
        end = F.least(F.octet_length("window"), F.col("at") - spare + F.col("be") - 1 + LENGTH)
        each = each.withColumns({"begin": begin, "end": end}).where(f"end - begin >= {LENGTH}")
        core = F.substring(F.col("window"), F.col("at") - spare + F.col("be"), F.col("al") - F.col("be") + 1 + LENGTH)
        each = each.select(
            F.xxhash64("group", "al", "be", core).alias("group"), "key", (F.col("lo") + F.col("begin")).alias("lo"), (F.col("at") - F.col("begin")).alias("at"), "many",
            F.substring(F.col("window"), F.col("begin") + 1, F.col("end") - F.col("begin")).alias("window"), "al", "be",
        )
        each = materialize(each.withColumn("digest", F.sha2("window", 256)), "halves")
        kinds = each.groupBy("group", "digest").agg(((F.count("*") > 1) | F.max("many")).alias("whole"), F.min(F.struct("key", "lo")).alias("one"))
        kinds = materialize(kinds, "half-kinds")
        told = each.join(kinds, ["group", "digest"])
        found = told.where("whole and not many").select("key", F.col("lo").alias("a"), (F.col("lo") + F.octet_length("window")).alias("b"))
        spans = found if spans is None else spans.unionByName(found)
        partner = (F.col("one.key") == F.col("key")) & (F.col("one.lo") == F.col("lo"))
        on = told.where(~F.col("whole") | partner).withColumn("many", F.col("whole")).drop("whole", "one", "digest")
        sizes = materialize(kinds.groupBy("group").agg(F.count("*").alias("size")).where("size > 1"), "half-sizes")
        on = on.join(sizes, "group")
        done = on.where(F.col("size") <= split).select("group", "key", "lo", "at", "many", "window")
        small = done if small is None else small.unionByName(done)
        if not sizes.where(F.col("size") > split).take(1):
            return small, spans
        live = on.where(F.col("size") > split).drop("size")


def repeated_spans(docs: DataFrame, split: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """(key, copies, text, ...) of the distinct texts with repeated anchors, and the (key, a, b) repeated in them,
    overlapping or not. Texts with several copies are only partners: all of them goes anyway."""
    small_batches(docs.sparkSession)
    text = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text")).where(F.octet_length("text") >= LENGTH)
    placed = materialize(text.mapInArrow(_anchor_rows, "anchor long, key binary, place int, reach int"), "anchor-places")
    twice = materialize(placed.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    hits = placed.join(twice, "anchor")
    by_text = hits.groupBy("key").agg(F.collect_set(F.struct("anchor", "place", "reach")).alias("hits"))
    by_text = by_text.select("key", *[F.col(f"hits.{c}").alias(c) for c in ("anchor", "place", "reach")])
    distinct = text.withColumn("key", _text_key()).groupBy("key").agg(F.count("*").alias("copies"), F.max("text").alias("text"))
    hit = bucketed(distinct.join(by_text, "key"), "key", "hit-texts")

    windows = hit.select("key", "copies", "text", "anchor", "place", "reach").mapInArrow(lambda it: _window_rows(it, LENGTH), _WINDOW)
    kinds = windows.groupBy("anchor", "d1", "d2").agg(F.sum("copies").alias("n"), F.min(F.struct("key", "place", "lo", "hi")).alias("one"))
    kinds = materialize(kinds, "windows")
    whole = windows.where("copies = 1").join(kinds.where("n > 1").select("anchor", "d1", "d2"), ["anchor", "d1", "d2"])
    spans = whole.select("key", F.col("lo").alias("a"), F.col("hi").alias("b"))

    mixed = materialize(kinds.groupBy("anchor").agg(F.count("*").alias("size")).where("size > 1"), "mixed-anchors")
    wanted = kinds.join(mixed, "anchor").groupBy("one.key").agg(F.collect_list(F.struct("anchor", "n", "one.place", "one.lo", "one.hi")).alias("wanted"))
    content = hit.select("key", "text").join(wanted, "key").mapInArrow(_fetched, _CONTENT)
    # Written, so that its size is known: few enough anchors are broadcast, else both sides are dealt.
    crowded = materialize(mixed.where(F.col("size") > split).select(F.col("anchor").alias("group")), "crowded")
    if crowded.take(1):
        content = materialize(content, "window-bytes")
        small, found = _halved(content.join(crowded, "group"), split)
        content = content.join(crowded, "group", "left_anti").unionByName(small)
        spans = spans.unionByName(found)
    shards = content.repartition("group").sortWithinPartitions("group", "key", "lo")
    spans = spans.unionByName(shards.mapInArrow(lambda it: _sorted_shards(it, LENGTH, STREAM), _SPAN))
    return hit, spans


def remove_repeats(docs: DataFrame, split: int = SPLIT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept (binary, the bytes that are left)
    and removed (spans as pairs a, b). kept is null where nothing goes: the text itself is left."""
    hit, spans = repeated_spans(docs, split)
    mine = spans.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    cleaned = hit.where("copies = 1").select("key", "text").join(mine, "key").mapInArrow(_cleaned, "key binary, n_removed long, n_spans long, removed array<struct<a:int,b:int>>, kept binary")
    whole = F.array(F.struct(F.lit(0).alias("a"), F.octet_length("text").alias("b")))
    copied = hit.where("copies > 1").select("key", F.octet_length("text").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), whole.alias("removed"), F.lit("").cast("binary").alias("kept"))
    results = cleaned.unionByName(copied)
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha256"))
    slim = slim.withColumn("key", F.substring(F.unhex("sha256"), 1, 16))
    out = slim.join(results, "key", "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), "removed", "kept", "sha256")
