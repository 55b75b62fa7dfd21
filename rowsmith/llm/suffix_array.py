"""Suffix arrays by induced sorting, and permuted common prefixes, as array operations.

Suffixes are classified as smaller (S) or larger (L) than their successor. The leftmost S
suffixes of each run are sorted by sorting the substrings between them (by inducing from
their first characters), naming equal ones alike and sorting the shorter text of names
recursively; all other suffixes follow by two linear scans over the buckets. A scan treats
the entries of a bucket in waves: a wave's predecessors are dealt to their buckets in one
stable step, and those that fall into the bucket itself form the next wave. Texts of names
mostly have more buckets than a wave each would pay for; they are scanned entry by entry,
to the same end.

Common prefixes are found in text order: of a suffix whose character before is also that
before its neighbour's, the prefix is one shorter than that of the suffix before it. Only the others are compared,
which takes at most n log n steps in all.
"""

from __future__ import annotations

import numpy as np

#: Entries a bucket for which scanning in waves pays; fewer are scanned one by one.
WAVE = 100
#: Entries of a wave that are dealt one by one.
FEW = 24


def smaller(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last one counts as smaller."""
    n = len(t)
    step = np.sign(np.diff(t.astype(np.int64)))
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1] if n > 1 else at
    out = np.ones(n, bool)
    out[:-1] = np.append(step, 1)[at] > 0
    return out


def _deal(sa: np.ndarray, edge: np.ndarray, found: np.ndarray, chars: np.ndarray, up: bool) -> None:
    """Put ``found`` into the buckets of ``chars`` in order, moving each bucket's edge."""
    if len(found) <= FEW:
        for j, c in zip(found.tolist(), chars.tolist(), strict=True):
            at = edge[c] if up else edge[c] - 1
            sa[at] = j
            edge[c] = at + 1 if up else at
        return
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    count = np.diff(np.append(first, len(c)))
    rank = np.arange(len(c)) - np.repeat(first, count)
    sa[edge[c] + rank if up else edge[c] - 1 - rank] = found[order]
    edge[c[first]] += count if up else -count


def induce(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The suffix array that follows from ``lms``, leftmost S suffixes in order. start: of buckets, and the end."""
    chars = np.flatnonzero(np.diff(start))
    if len(t) < WAVE * len(chars):
        return _induce_singly(t, is_s, lms, start)
    sa = np.full(len(t), -1, np.int64)
    of = t[lms]
    by = np.argsort(of, kind="stable")
    cut = np.searchsorted(of[by], np.arange(len(start)))
    seeds = lms[by]

    head = start[:-1].copy()

    def larger(block: np.ndarray) -> None:
        j = block[block > 0] - 1
        j = j[~is_s[j]]
        if len(j):
            _deal(sa, head, j, t[j], True)

    for c in chars:
        done = start[c]
        while done < head[c]:
            block = sa[done : head[c]]
            done = head[c]
            larger(block)
        if cut[c + 1] > cut[c]:
            larger(seeds[cut[c] : cut[c + 1]])

    tail = start[1:].copy()

    def less(block: np.ndarray) -> None:
        j = block[block > 0] - 1
        j = j[is_s[j]]
        if len(j):
            _deal(sa, tail, j, t[j], False)

    last = len(t) - 1
    for c in chars[::-1]:
        if c == t[last] and is_s[last] and c == chars[0]:
            # The end mark is the only suffix of its bucket, and the smallest.
            sa[start[c]] = last
            less(sa[start[c] : start[c] + 1])
            continue
        done = start[c + 1]
        while tail[c] < done:
            block = sa[tail[c] : done][::-1]
            done = tail[c]
            less(block)
        if head[c] > start[c]:
            less(sa[start[c] : head[c]][::-1])
    return sa


def _induce_singly(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The same, one entry after the other."""
    # Of each entry the bucket that its predecessor goes to in either scan, if any; -1 stands for no entry, too.
    larger, less = np.full(len(t) + 1, -1, np.int64), np.full(len(t) + 1, -1, np.int64)
    larger[1:-1] = np.where(is_s[:-1], -1, t[:-1])
    less[1:-1] = np.where(is_s[:-1], t[:-1], -1)
    sa, to = [-1] * len(t), larger.tolist()
    tail = start[1:].tolist()
    for j, c in zip(lms[::-1].tolist(), t[lms[::-1]].tolist(), strict=True):
        tail[c] -= 1
        sa[tail[c]] = j
    head = start[:-1].tolist()
    for j in sa:  # grows ahead of the scan
        c = to[j]
        if c >= 0:
            at = head[c]
            sa[at] = j - 1
            head[c] = at + 1
    tail, to = start[1:].tolist(), less.tolist()
    for i in range(len(sa) - 1, -1, -1):
        j = sa[i]
        c = to[j]
        if c >= 0:
            at = tail[c] = tail[c] - 1
            sa[at] = j - 1
    return np.array(sa, np.int64)


def names(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Names by rank of the substrings that begin at ``lms`` (in text order), given the sorted ``order``; how many."""
    n = len(t)
    stop = np.full(n, n - 1, np.int64)
    stop[lms[:-1]] = lms[1:]
    a, b = order[:-1], order[1:]
    differ = (stop[a] - a) != (stop[b] - b)
    differ |= (a == n - 1) | (b == n - 1)
    live, k = np.flatnonzero(~differ), 0
    while len(live):
        x, y = a[live] + k, b[live] + k
        off = (t[x] != t[y]) | (is_s[x] != is_s[y])
        differ[live[off]] = True
        live = live[~off & (x < stop[a[live]])]
        k += 1
    rank = np.concatenate([[0], np.cumsum(differ)])
    out = np.empty(n, np.int64)
    out[order] = rank
    return out[lms], int(rank[-1]) + 1


def suffix_array(t: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of ``t``, integers below ``sigma``, whose last one is 0 and occurs once."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    is_s = smaller(t)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    start = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=sigma))])
    if len(lms) > 1:
        sa = induce(t, is_s, lms, start)
        mark = np.zeros(n, bool)
        mark[lms] = True
        order = sa[mark[sa]]
        short, count = names(t, is_s, lms, order)
        lms = order if count == len(lms) else lms[suffix_array(short, count)]
    return induce(t, is_s, lms, start)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place of ``t`` (integers below 65536, the last one 0 and the only one) the length of the common
    prefix of its suffix with the one before it in ``sa``; 0 for the first."""
    n = len(t)
    before = np.empty(n, np.int64)
    before[sa[0]] = -1
    before[sa[1:]] = sa[:-1]
    prev = np.concatenate([[-1], t[:-1]])
    own = np.flatnonzero((before < 0) | (prev != prev[before]) | (prev < 0) | (before == 0))
    words = np.lib.stride_tricks.sliding_window_view(np.concatenate([t, np.zeros(4, t.dtype)]).astype(np.uint16), 4)
    four = lambda at: np.ascontiguousarray(words[at]).view("<u8")[:, 0]
    length = np.zeros(len(own), np.int64)
    live = np.flatnonzero(before[own] >= 0)
    while len(live):
        k = length[live]
        x = four(own[live] + k) ^ four(before[own[live]] + k)  # the end mark, which occurs once, stops every comparison
        low = x & (~x + np.uint64(1))
        length[live] = k + np.where(x != 0, np.log2(np.maximum(low, np.uint64(1)).astype(float)).astype(np.int64) // 16, 4)
        live = live[x == 0]
    out = np.zeros(n, np.int64)
    out[own] = length + own
    last = np.zeros(n, np.int64)
    last[own] = own
    return out[np.maximum.accumulate(last)] - np.arange(n)  # one less for each step on from a place compared
