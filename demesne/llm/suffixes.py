"""Suffix arrays of bounded blocks by induced sorting, and their permuted common prefixes, in array arithmetic.

`suffix_array` classifies suffixes, sorts the leftmost smaller (LMS) substrings by inducing, sorts
the LMS suffixes by the names of their substrings (recursively, while the names are few; by doubling
where they are many), and induces the whole order. Inducing goes bucket by bucket: everything that a
bucket holds is scanned at once, what it adds to itself in following waves, so an array of n
small symbols costs a few passes over n, and one small step for each bucket and wave.
"""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are sorted by buckets.
BUCKETS = 1024


def _spread(heads: np.ndarray, chars: np.ndarray, out: np.ndarray, values: np.ndarray, step: int) -> None:
    """Append values to the buckets of their characters, in order, upwards (step 1) or downwards (-1)."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    new = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    size = np.diff(np.append(new, len(c)))
    rank = np.arange(len(c)) - np.repeat(new, size)
    out[heads[c] + step * rank] = values[order]
    heads[c[new]] += step * size


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The order of all suffixes induced from LMS suffixes given in order."""
    n, k = len(t), len(sizes)
    sa = np.full(n, -1, np.int32)
    first = np.concatenate([[0], np.cumsum(sizes)])
    # L-type suffixes, upwards: in each bucket first what was put there, wave by wave, then its LMS suffixes.
    heads = first[:-1].copy()
    own = t[lms]
    by = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=k))])
    lms_sorted = lms[np.argsort(own, kind="stable")]
    for c in range(k):
        a = first[c]
        while a < heads[c]:
            b = heads[c]
            j = sa[a:b]
            p = j[j > 0] - 1
            p = p[~small[p]]
            if len(p):
                _spread(heads, t[p], sa, p, 1)
            a = b
        if by[c + 1] > by[c]:
            j = lms_sorted[by[c] : by[c + 1]]
            p = j[j > 0] - 1
            p = p[~small[p]]
            if len(p):
                _spread(heads, t[p], sa, p, 1)
    # S-type suffixes, downwards: in each bucket first what was put at its end, then its L-type suffixes.
    tails = first[1:] - 1
    large_end = heads
    sa[0], tails[0] = n - 1, -1  # no suffix induces the sentinel
    for c in range(k - 1, -1, -1):
        b = first[c + 1] - 1
        while b > tails[c]:
            a = tails[c]
            j = sa[a + 1 : b + 1][::-1]
            p = j[j > 0] - 1
            p = p[small[p]]
            if len(p):
                _spread(tails, t[p], sa, p, -1)
            b = a
        j = sa[first[c] : large_end[c]][::-1]
        p = j[j > 0] - 1
        p = p[small[p]]
        if len(p):
            _spread(tails, t[p], sa, p, -1)
    return sa


def _doubled(names: np.ndarray) -> np.ndarray:
    """The suffix order of an array over a large alphabet, by doubling."""
    n = len(names)
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] if step < n else 0
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        s = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[True], s[1:] != s[:-1]]))
        if rank[order[-1]] == n or step >= n:
            return order.astype(np.int32)
        step *= 2


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of an array of small non-negative integers whose last one is the only 0."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    k = int(t.max()) + 1
    if k > BUCKETS:
        return _doubled(t)
    t = t.astype(np.int16)
    # S-type: smaller than the next suffix; a run of equal symbols is decided where it ends.
    differ = np.concatenate([t[:-1] != t[1:], [True]])
    ends = np.flatnonzero(differ)
    decided = ends[np.searchsorted(ends, np.arange(n))]
    following = np.concatenate([t[1:], [-1]])
    small = following[decided] > t[decided]
    small[-1] = True
    is_lms = small & np.concatenate([[False], ~small[:-1]])
    lms = np.flatnonzero(is_lms).astype(np.int32)
    sizes = np.bincount(t, minlength=k)
    if len(lms) > 1:
        sorted_lms = _induce(t, small, lms, sizes)
        sorted_lms = sorted_lms[is_lms[sorted_lms]]
        names = _names(t, lms, sorted_lms)
        if names.max() + 1 < len(lms):
            # The last LMS substring is the sentinel, the only one named 0.
            lms = lms[suffix_array(names)]
        else:
            lms = sorted_lms
    return _induce(t, small, lms, sizes)


def _names(t: np.ndarray, lms: np.ndarray, in_order: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings, in the order of the text: equal ones have equal names."""
    place = np.searchsorted(lms, in_order)
    length = np.diff(np.append(lms, len(t) - 1)) + 1
    size = length[place]
    same = np.zeros(len(lms), bool)
    same[1:] = size[1:] == size[:-1]
    a, b, left = in_order[1:].astype(np.int64), in_order[:-1].astype(np.int64), size[1:].astype(np.int64)
    live = np.flatnonzero(same[1:])
    step = 0
    while len(live):
        equal = t[a[live] + step] == t[b[live] + step]
        same[live[~equal] + 1] = False
        step += 1
        live = live[equal]
        live = live[left[live] > step]
    rank = np.cumsum(~same) - 1
    out = np.empty(len(lms), np.int64)
    out[place] = rank
    return out


def permuted_lcp(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, the common prefix with the suffix before it in the order; 0 for the first.

    Only irreducible values, where the symbols before the two suffixes differ, are found by comparing;
    each other one is one less than that of the position before it.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    known = before < 0
    reducible = np.zeros(n, bool)
    reducible[1:] = (before[1:] > 0) & ~known[1:] & (t[:-1] == t[np.maximum(before[1:], 1) - 1]) & (before[:-1] == before[1:] - 1)
    irreducible = np.flatnonzero(~reducible & ~known)
    out = np.zeros(n, np.int32)
    live, depth = irreducible, 0
    other = before[live]
    while len(live):
        inside = np.maximum(live, other) + depth < n
        equal = np.zeros(len(live), bool)
        equal[inside] = t[live[inside] + depth] == t[other[inside] + depth]
        out[live[~equal]] = depth
        live, other = live[equal], other[equal]
        depth += 1
    start = np.maximum.accumulate(np.where(~reducible, at, 0))
    return np.where(reducible, out[start] - (at - start), out).astype(np.int32)
