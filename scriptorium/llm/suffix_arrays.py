"""Suffix arrays by induced sorting, and permuted common prefixes, as vector operations.

Suffixes are classed S (smaller than the next suffix) or L; leftmost S suffixes (LMS) are sorted by sorting
their substrings through one inducing pass and then the string of their names, recursively; a second pass
induces all others from them.  An inducing pass scans buckets of one first symbol; all entries of a bucket that
are known are handled as one vector, and again while they add entries to their own bucket.  A name string
with more symbols than BUCKETS would need a loop step per symbol, so it is sorted by doubling ranks instead.
"""

from __future__ import annotations

import numpy as np

BUCKETS = 1024


def _s_types(s: np.ndarray) -> np.ndarray:
    """True for S; the end of the string is smaller than any symbol."""
    n = len(s)
    change = np.zeros(n, np.int8)
    change[:-1] = np.sign(np.diff(s.astype(np.int64)))
    change[-1] = -1
    at = np.where(change != 0, np.arange(n), n)
    return change[np.minimum.accumulate(at[::-1])[::-1]] > 0


def _place(sa: np.ndarray, edge: np.ndarray, j: np.ndarray, symbols: np.ndarray, sigma: int, way: int) -> None:
    """Put j at the edges of their symbols' buckets, in order; move the edges."""
    order = np.argsort(symbols, kind="stable")
    j, symbols = j[order], symbols[order]
    counts = np.bincount(symbols, minlength=sigma)
    rank = np.arange(len(j)) - (np.cumsum(counts) - counts)[symbols]
    sa[edge[symbols] + way * rank] = j
    edge += way * counts


def _induce(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """All suffixes in order, if lms is in order; LMS substrings in order, if lms is in any order."""
    n = len(s)
    counts = np.bincount(s, minlength=sigma)
    ends = np.cumsum(counts)
    starts = ends - counts
    sa = np.full(n, -1, np.int64)
    tail = ends - 1
    _place(sa, tail, lms[::-1], s[lms[::-1]], sigma, -1)
    head, seeds = starts.copy(), tail + 1
    before = np.concatenate([[-1], s[:-1]])  # the symbol before each suffix
    sa[head[s[-1]]] = n - 1
    head[s[-1]] += 1
    used = np.flatnonzero(counts)
    for c in used:
        scanned = starts[c]
        while scanned < head[c]:
            part = sa[scanned : head[c]]
            scanned = head[c]
            part = part[before[part] >= c]
            if len(part):
                _place(sa, head, part - 1, before[part], sigma, 1)
        part = sa[seeds[c] : ends[c]]
        part = part[before[part] > c]
        if len(part):
            _place(sa, head, part - 1, before[part], sigma, 1)
    tail = ends - 1
    for c in used[::-1]:
        scanned = ends[c] - 1
        while scanned > tail[c]:
            part = sa[tail[c] + 1 : scanned + 1][::-1]
            scanned = tail[c]
            part = part[(part > 0) & (before[part] <= c)]
            if len(part):
                _place(sa, tail, part - 1, before[part], sigma, -1)
        part = sa[starts[c] : head[c]][::-1]
        part = part[(part > 0) & (before[part] < c)]
        if len(part):
            _place(sa, tail, part - 1, before[part], sigma, -1)
    return sa


def _double(s: np.ndarray, depth: int | None) -> np.ndarray:
    rank, k, n = np.unique(s, return_inverse=True)[1].astype(np.int64), 1, len(s)
    order = np.argsort(rank, kind="stable")
    while k < n and (depth is None or k < depth):
        after = np.full(n, -1, np.int64)
        after[:-k] = rank[k:]
        both = rank * (n + 1) + after + 1
        order = np.argsort(both, kind="stable")
        ordered = both[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if rank[order[-1]] == n - 1:
            break
        k *= 2
    return order


def _names(s: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Names of neighbouring sorted substrings: equal ones share a name."""
    differ = lengths[1:] != lengths[:-1]
    same, k = np.flatnonzero(~differ), 0
    while len(same):
        same = same[lengths[same] > k]
        odd = s[starts[same] + k] != s[starts[same + 1] + k]
        differ[same[odd]] = True
        same, k = same[~odd], k + 1
    return np.cumsum(np.concatenate([[0], differ]))


def suffix_array(s: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Starts of the suffixes of s (integers from 0) in order.

    With depth, suffixes that agree on so many symbols may come in any order among themselves."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    s = s.astype(np.int64)
    sigma = int(s.max()) + 1
    if sigma > BUCKETS:
        return _double(s, depth)
    is_s = _s_types(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if len(lms) < 2:
        return _induce(s, is_s, lms, sigma)
    sa = _induce(s, is_s, lms, sigma)
    mark = np.zeros(n, bool)
    mark[lms] = True
    ordered = sa[mark[sa]]
    following = np.concatenate([lms[1:], [n - 1]])
    place = np.empty(n, np.int64)
    place[lms] = np.arange(len(lms))
    names = _names(s, ordered, (following - lms)[place[ordered]] + 1)
    # the last LMS substring runs to the end; it has a name of its own, before its equals
    string = np.empty(len(lms), np.int64)
    string[place[ordered]] = names
    if names[-1] == len(lms) - 1:
        order = place[ordered]
    else:
        order = suffix_array(string, None if depth is None else max(1, depth // 2 + 1))
    return _induce(s, is_s, lms[order], sigma)


def common_prefixes(s: np.ndarray, order: np.ndarray, most: int | None = None, heads: np.ndarray | None = None) -> np.ndarray:
    """Of each suffix in order, the symbols it shares with the one before it.

    By text position: where a suffix and its predecessor both move on by one, the value falls by one; only
    the others (irreducible ones) are compared, symbol by symbol, all at once.  With most, comparisons end there.
    heads marks positions that are compared anew, as where strings begin in a text of many strings."""
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    inside = before >= 0
    follows = np.zeros(n, bool)
    follows[1:] = inside[1:] & inside[:-1] & (before[1:] == before[:-1] + 1) & (s[:-1] == s[before[:-1]])
    if heads is not None:
        follows &= ~heads
    value = np.zeros(n, np.int64)
    left, k = np.flatnonzero(inside & ~follows), 0
    while len(left) and (most is None or k < most):
        left = left[(left + k < n) & (before[left] + k < n)]
        left = left[s[left + k] == s[before[left] + k]]
        k += 1
        value[left] = k
    last = np.maximum.accumulate(np.where(follows, 0, np.arange(n)))
    return np.maximum(np.where(follows, value[last] - (np.arange(n) - last), value), 0)[order]
