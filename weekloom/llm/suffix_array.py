"""Suffix arrays by induced sorting and permuted longest common prefixes, in numpy.

Suffixes are classified as larger (L) or smaller (S) than their successor. The leftmost S suffixes (LMS) are
sorted, and all others follow from them in two linear passes over the character buckets: L suffixes from left
to right, S suffixes from right to left. A pass handles a bucket at once: the suffixes induced by it go to
later buckets in its order, and those that fall into the same bucket (runs of one character) form the next
wave of that bucket.

LMS substrings are ordered by the same two passes started from any order of the LMS suffixes, and named by
comparing neighbours. If names repeat, the string of names is sorted: recursively while it has few different
names, else by doubling of ranks, because a pass needs one step per bucket.
"""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are sorted by induction.
BUCKETS = 2048


def classify(t: np.ndarray) -> np.ndarray:
    """True for S suffixes. ``t`` ends with a unique least value."""
    n = len(t)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(t[1:].astype(np.int64) - t[:-1])
    step[-1] = 1
    at = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    return step[following] > 0


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Suffix array from LMS suffixes given in order within each bucket."""
    n, sigma = len(t), len(sizes)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    lms_of = np.split(lms, np.cumsum(np.bincount(t[lms], minlength=sigma))[:-1])
    left: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    right: list[list[np.ndarray]] = [[] for _ in range(sigma)]

    def spread(found: np.ndarray, to: list[list[np.ndarray]], own: int, s_type: bool):
        """Predecessors of ``found`` of the wanted type, dealt to their buckets; those of ``own`` are returned."""
        p = found[found > 0] - 1
        p = p[small[p] == s_type]
        c = t[p]
        stay = p[c == own]
        p, c = p[c != own], c[c != own]
        if len(p):
            order = np.argsort(c, kind="stable")
            p, c = p[order], c[order]
            cut = np.flatnonzero(c[1:] != c[:-1]) + 1
            for part, k in zip(np.split(p, cut), c[np.concatenate([[0], cut])].tolist(), strict=True):
                to[k].append(part)
        return stay

    l_sorted: list[np.ndarray] = []
    none = np.zeros(0, np.int64)
    for c in range(sigma):
        wave = np.concatenate(left[c]) if left[c] else none
        waves = []
        while len(wave):
            waves.append(wave)
            wave = spread(wave, left, c, False)
        l_sorted.append(np.concatenate(waves) if waves else none)
        if len(lms_of[c]):
            spread(lms_of[c], left, c, False)
    out = np.empty(n, np.int64)
    for c in range(sigma - 1, -1, -1):
        # From right to left: parts arrive in descending order and waves put the next one before.
        wave = np.concatenate(right[c]) if right[c] else none
        waves = []
        while len(wave):
            waves.append(wave)
            wave = spread(wave, right, c, True)
        s_part = np.concatenate(waves)[::-1] if waves else none
        if c == 0:
            s_part = np.array([n - 1])
        l_part = l_sorted[c]
        out[begins[c] : begins[c] + len(l_part)] = l_part
        out[ends[c] - len(s_part) : ends[c]] = s_part
        if len(l_part):
            spread(l_part[::-1], right, c, True)
    return out


def _names(t: np.ndarray, order: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Name of each LMS substring (in text order), equal for equal substrings, given their sorted order."""
    place = np.full(len(t), -1, np.int64)
    place[lms] = np.arange(len(lms))
    length = np.diff(np.append(lms, len(t) - 1)) + 1
    a, b = order[:-1], order[1:]
    la, lb = length[place[a]], length[place[b]]
    same = la == lb
    live = np.flatnonzero(same)
    k = 0
    while len(live):
        differ = t[a[live] + k] != t[b[live] + k]
        same[live[differ]] = False
        k += 1
        live = live[~differ]
        live = live[la[live] > k]
    name = np.empty(len(lms), np.int64)
    name[place[order]] = np.concatenate([[0], np.cumsum(~same)])
    return name, int((~same).sum()) + 1


def _by_doubling(x: np.ndarray) -> np.ndarray:
    """Suffix array of a string of names by sorting pairs of ranks."""
    rank, k, n = x.astype(np.int64) + 1, 1, len(x)
    while True:
        second = np.zeros(n, np.int64)
        second[: n - k] = rank[k:] if k < n else 0
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[1], 1 + np.cumsum(key[order[1:]] != key[order[:-1]])])
        if new[order[-1]] == n:
            return order
        rank, k = new, 2 * k


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``values`` (integers from 1 on)."""
    if not len(values):
        return np.zeros(0, np.int64)
    t = np.append(values, 0).astype(np.int64)
    return _sorted(t, int(t.max()) + 1)[1:]


def _sorted(t: np.ndarray, sigma: int) -> np.ndarray:
    if len(t) < 2:
        return np.arange(len(t))
    small = classify(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sizes = np.bincount(t, minlength=sigma)
    by_bucket = lms[np.argsort(t[lms], kind="stable")]
    rough = _induce(t, small, by_bucket, sizes)
    is_lms = np.zeros(len(t), bool)
    is_lms[lms] = True
    order = rough[is_lms[rough]]
    name, count = _names(t, order, lms)
    if count < len(lms):
        if count <= BUCKETS and len(lms) > 4 * BUCKETS:
            order = lms[_sorted(np.append(name + 1, 0), count + 1)[1:]]
        else:
            order = lms[_by_doubling(name)]
    return _induce(t, small, order, sizes)


def permuted_lcp(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every position in text order: length of the common prefix with its predecessor in the suffix array,
    and that predecessor (-1: none).

    Where the characters before a position and before its predecessor agree, the value is one less than the one
    before; only the other positions are compared, eight bytes at a time."""
    n = len(t)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    i = np.arange(n)
    reducible = np.zeros(n, bool)
    has = (phi > 0) & (i > 0)
    reducible[has] = t[i[has] - 1] == t[phi[has] - 1]
    reducible[1:] &= phi[1:] > 0
    start = np.flatnonzero(~reducible & (phi >= 0))
    raw = np.concatenate([t.astype(np.uint8), np.zeros(16, np.uint8)])
    wide = np.ndarray((len(raw) - 7,), np.dtype("<u8"), raw.data, strides=(1,))
    a, b = start, phi[start]
    length = np.zeros(len(start), np.int64)
    live = np.arange(len(start))
    while len(live):
        pa, pb = a[live] + length[live], b[live] + length[live]
        inside = (pa < n) & (pb < n)
        live, pa, pb = live[inside], pa[inside], pb[inside]
        equal = wide[pa] == wide[pb]
        x = wide[pa[~equal]] ^ wide[pb[~equal]]
        low = x & (~x + np.uint64(1))
        length[live[~equal]] += np.floor(np.log2(low.astype(np.float64))).astype(np.int64) // 8
        live = live[equal]
        length[live] += 8
    length = np.minimum(length, n - np.maximum(a, b))
    reach = np.zeros(n, np.int64)
    reach[start] = start + length
    reach = np.maximum.accumulate(reach)
    return np.where(phi >= 0, np.maximum(reach - i, 0), 0), phi
