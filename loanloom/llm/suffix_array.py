"""Suffix arrays of shards by induced sorting, and permuted longest common prefixes.

Symbols are small integers with a unique least one at the end. The induction steps run bucket by bucket on whole
arrays, in time linear in the text. The reduced string of leftmost-smaller substrings is sorted by naming its parts
recursively, since its large alphabet has too many buckets for array operations.
"""
from __future__ import annotations

import numpy as np

#: Largest alphabet whose buckets are worth array operations of their own.
_SMALL = 1024


def classify(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one."""
    n = len(t)
    step = np.sign(np.diff(t.astype(np.int64)))
    at = np.where(step != 0, np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = step[at] > 0
    return out


def _induce_arrays(t: np.ndarray, small: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    n = len(t)
    counts = np.bincount(t, minlength=size)
    ends = np.cumsum(counts)
    starts = ends - counts
    sa = np.empty(n, np.int64)
    heads, tails = starts.copy(), ends.copy()
    sa[0], tails[0] = n - 1, 0
    keys = t.astype(np.uint16)

    def push(source: np.ndarray, want_small: bool) -> None:
        j = source[source > 0] - 1
        j = j[small[j] == want_small]
        if not len(j):
            return
        c = keys[j]
        order = np.argsort(c, kind="stable")
        j, c = j[order], c[order].astype(np.int64)
        each = np.bincount(c, minlength=size)
        rank = np.arange(len(j)) - (np.cumsum(each) - each)[c]
        if want_small:
            sa[tails[c] - 1 - rank] = j
            np.subtract(tails, each, out=tails)
        else:
            sa[heads[c] + rank] = j
            np.add(heads, each, out=heads)

    first = keys[lms].astype(np.int64)
    bounds = np.searchsorted(first, np.arange(size + 1))
    for c in np.flatnonzero(counts):
        done = starts[c]
        while done < heads[c]:
            now, done = sa[done : heads[c]].copy(), heads[c]
            push(now, False)
        if bounds[c] < bounds[c + 1]:
            push(lms[bounds[c] : bounds[c + 1]], False)
    for c in np.flatnonzero(counts)[::-1]:
        done = ends[c] if c else 1
        while tails[c] < done:
            now, done = sa[tails[c] : done][::-1].copy(), tails[c]
            push(now, True)
        if starts[c] < heads[c]:
            push(sa[starts[c] : heads[c]][::-1].copy(), True)
    return sa


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """The suffixes of a reduced string in order. Its names stand for substrings that grow recursively: each step
    names pairs of neighbouring names anew, for the suffixes that still tie, until none does."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    start = np.concatenate(([True], names[order[1:]] != names[order[:-1]]))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    live, width = order[~(start & np.append(start[1:], True))], 1
    while len(live):
        own, after = rank[live], rank[np.minimum(live + width, n)]
        by = np.lexsort((after, own)) if n > 2_000_000_000 else np.argsort(own * (n + 1) + after + 1, kind="stable")
        live, own, after = live[by], own[by], after[by]
        group = np.concatenate(([True], own[1:] != own[:-1]))
        start = group | np.concatenate(([True], after[1:] != after[:-1]))
        place = np.arange(len(live))
        rank[live] = own + np.maximum.accumulate(np.where(start, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        live = live[~(start & np.append(start[1:], True))]
        width *= 2
    out = np.empty(n, np.int64)
    out[rank[:n]] = np.arange(n)
    return out


def _names(t: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """By text order, the rank of each leftmost-smaller substring; equal substrings share one."""
    n, m = len(t), len(lms)
    length = np.append(np.diff(lms), 1)
    where = np.empty(n, np.int64)
    where[lms] = np.arange(m)
    at = where[order]
    a, b = at[:-1], at[1:]
    differ = length[a] != length[b]
    live = np.flatnonzero(~differ)
    k = 0
    while len(live):
        bad = t[lms[a[live]] + k] != t[lms[b[live]] + k]
        differ[live[bad]] = True
        live = live[~bad]
        k += 1
        live = live[length[a[live]] >= k]
    rank = np.concatenate(([0], np.cumsum(differ)))
    out = np.empty(m, np.int64)
    out[at] = rank
    return out


def suffix_array(t: np.ndarray, size: int) -> np.ndarray:
    """``t``: integers below ``size``, the last one unique and least."""
    n = len(t)
    if n < 3:
        return np.arange(n)[::-1].copy()
    if size > _SMALL:
        return _sorted_names(t)
    small = classify(t)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms)
    rough = lms[np.argsort(t[lms], kind="stable")]
    sa = _induce_arrays(t, small, rough, size)
    order = sa[is_lms[sa]]
    names = _names(t, lms, order)
    if names.max() + 1 < len(lms):
        order = lms[suffix_array(names, int(names.max()) + 1)]
    return _induce_arrays(t, small, order, size)


def permuted_lcp(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, the common prefix of its suffix and the one before it in ``sa``.

    A value whose left neighbours agree is one less than the value before it, so only the others are compared.
    """
    n = len(t)
    before = np.empty(n, np.int64)
    before[sa[0]] = n - 1 if sa[0] != n - 1 else 0
    before[sa[1:]] = sa[:-1]
    here = np.arange(n)
    fresh = (here == 0) | (before == 0)
    fresh |= t[here - 1] != t[before - 1]
    fresh[sa[0]] = True
    if sa[0] + 1 < n:
        fresh[sa[0] + 1] = True
    i = np.flatnonzero(fresh)
    i = i[i != sa[0]]
    j = before[i]
    wide = np.zeros(n + 8, np.uint16)
    wide[:n] = t
    words = np.ndarray(n + 4, np.uint64, wide.data, strides=(2,))
    value = np.zeros(n, np.int64)
    live, k = np.arange(len(i)), 0
    while len(live):
        room = n - k - np.maximum(i[live], j[live])
        live = live[room > 0]
        same = words[i[live] + k] == words[j[live] + k]
        ends = live[~same]
        x = words[i[ends] + k] ^ words[j[ends] + k]
        low = np.zeros(len(ends), np.int64)
        for step in (16, 32, 48):
            low += (x & np.uint64((1 << step) - 1)) == 0
        value[i[ends]] = k + low
        live = live[same]
        k += 4
    last = np.maximum.accumulate(np.where(fresh, here, 0))
    out = value[last] - (here - last)
    out[sa[0]] = 0
    return out
