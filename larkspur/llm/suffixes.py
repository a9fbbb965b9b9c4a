"""Suffix arrays by induced sorting, and permuted common prefixes.

The first level, whose alphabet is small, induces a whole bucket at a time with numpy; the reduced
strings of deeper levels have large alphabets and are short, and are induced suffix by suffix.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of ``text`` (integers from 1), in order; a prefix comes first."""
    s = np.append(np.asarray(text, np.int64), 0)
    if len(s) == 1:
        return np.zeros(0, np.int64)
    smaller = _smaller(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    order = _induce(s, smaller, lms[np.argsort(s[lms], kind="stable")])
    place = np.full(len(s), -1, np.int64)
    place[lms] = np.arange(len(lms))
    found = place[order]
    found = found[found >= 0]  # the leftmost smaller substrings, sorted
    names, count = _names(s, lms, found)
    if count < len(lms):
        found = np.array(_sorted_list(names, count), np.int64)
    return _induce(s, smaller, lms[found])[1:]


def _smaller(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last, an end mark, is."""
    step = np.append(np.sign(np.diff(s)), 1)
    at = np.where(step != 0, np.arange(len(s)), len(s))
    following = np.minimum.accumulate(at[::-1])[::-1]
    return step[following] > 0


def _names(s: np.ndarray, lms: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the leftmost smaller substrings in text order: equal ones, equal names. From 0."""
    ends = np.append(lms[1:], len(s) - 1)
    starts, sizes = lms[found], (ends - lms)[found]
    same = np.flatnonzero(sizes[1:] == sizes[:-1])
    a, b, size = starts[same], starts[same + 1], sizes[same]
    k = 0
    while len(same):
        # The last character compared is the first of the next substring.
        equal = s[a + k] == s[b + k]
        done = equal & (size == k)
        if k == 0:
            final = []
        final.append(same[done])
        left = equal & ~done
        same, a, b, size = same[left], a[left], b[left], size[left]
        k += 1
    fresh = np.ones(len(found), np.int64)
    if len(found) > 1 and k:
        fresh[np.concatenate(final) + 1] = 0
    names = np.empty(len(found), np.int64)
    names[found] = np.cumsum(fresh) - 1
    return names, int(fresh.sum())


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost smaller ones in (the buckets') order."""
    size = int(s.max()) + 1
    count = np.bincount(s, minlength=size)
    begin = np.concatenate((np.zeros(1, np.int64), np.cumsum(count)))
    larger = np.bincount(s[~smaller], minlength=size)
    chars = np.flatnonzero(count)
    order = np.full(len(s), -1, np.int64)
    cuts = np.searchsorted(s[lms], np.arange(size + 1))

    fill = begin[:-1].copy()

    def put(e: np.ndarray, kind: bool, sign: int) -> None:
        j = e[e > 0] - 1
        j = j[smaller[j] == kind]
        if not len(j):
            return
        c = s[j]
        by = np.argsort(c.astype(np.uint16), kind="stable") if size < 65536 else np.argsort(c, kind="stable")
        j, c = j[by], c[by]
        new = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        sizes = np.diff(np.append(new, len(c)))
        rank = np.arange(len(c)) - np.repeat(new, sizes)
        order[fill[c] + rank if sign > 0 else fill[c] - 1 - rank] = j
        fill[c[new]] += sign * sizes

    for c in chars.tolist():
        at = int(begin[c])
        while at < fill[c]:
            to = int(fill[c])
            put(order[at:to].copy(), False, 1)
            at = to
        put(lms[cuts[c] : cuts[c + 1]], False, 1)
    fill = begin[1:].copy()
    order[0] = len(s) - 1
    fill[0] = 0
    for c in chars[::-1].tolist():
        at = int(begin[c + 1])
        while at > fill[c]:
            to = int(fill[c])
            put(order[to:at][::-1].copy(), True, -1)
            at = to
        put(order[begin[c] : begin[c] + larger[c]][::-1].copy(), True, -1)
    return order


def _sorted_list(names: np.ndarray, size: int) -> list[int]:
    """Order of the suffixes of ``names``, whose last element is a single smallest one."""
    n = len(names)
    if size == n:
        return np.argsort(names).tolist()
    kinds = _smaller(names)
    lms = np.flatnonzero(kinds[1:] & ~kinds[:-1]) + 1
    s, smaller = names.tolist(), kinds.tobytes()
    counts = [0] * size
    for c in s:
        counts[c] += 1
    begins, ends, total = [0] * size, [0] * size, 0
    for c in range(size):
        begins[c] = total
        total += counts[c]
        ends[c] = total

    def induce(sorted_lms: list[int]) -> list[int]:
        order = [-1] * n
        tails = ends[:]
        for i in reversed(sorted_lms):
            c = s[i]
            tails[c] -= 1
            order[tails[c]] = i
        heads = begins[:]
        for x in order:  # grows ahead of the scan
            if x > 0 and not smaller[x - 1]:
                c = s[x - 1]
                order[heads[c]] = x - 1
                heads[c] += 1
        tails = ends[:]
        for k in range(n - 1, -1, -1):
            x = order[k]
            if x > 0 and smaller[x - 1]:
                c = s[x - 1]
                tails[c] -= 1
                order[tails[c]] = x - 1
        return order

    place = np.full(n, -1, np.int64)
    place[lms] = np.arange(len(lms))
    found = place[np.array(induce(lms.tolist()), np.int64)]
    found = found[found >= 0]
    deeper, count = _names(names, lms, found)
    return induce(lms[np.array(_sorted_list(deeper, count), np.int64)].tolist())


#: Distance of the places whose common prefixes are compared first.
STEP = 16


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """For each place of ``text`` the bytes (at least ``most``, if it says so) its suffix shares with the one
    before it in ``order``: common prefixes permuted into text order. The first suffix shares none.

    From one place to the next such a prefix shrinks by one byte at most, so every ``STEP``-th place gives the
    others a start. ``wanted`` marks the places of interest; others may be left at their start.
    """
    text = np.asarray(text, np.uint8)
    count = len(text)
    before = np.full(count, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(count, np.int64)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.as_strided(padded, (count + 1, 8), (1, 1)).copy().view(np.uint64).reshape(-1)
    asked = before >= 0 if wanted is None else (before >= 0) & wanted

    def extend(live: np.ndarray, most: int) -> None:
        every, other, done = live, before[live], shared[live]
        while len(live):
            go = (done < most) & (np.maximum(live, other) + done + 8 <= count)
            live, other, done = live[go], other[go], done[go]
            equal = words[live + done] == words[other + done]
            live, other, done = live[equal], other[equal], done[equal] + 8
            shared[live] = done
        # The last bytes, for those that stopped short.
        live = every[shared[every] < most]
        other, done = before[live], shared[live]
        while len(live):
            go = np.maximum(live, other) + done < count
            live, other, done = live[go], other[go], done[go]
            equal = text[live + done] == text[other + done]
            live, other, done = live[equal], other[equal], done[equal] + 1
            shared[live] = done

    first = np.zeros(count, bool)
    first[::STEP] = True
    extend(np.flatnonzero(asked & first), most + STEP)
    start = np.repeat(shared[::STEP], STEP)[:count] - np.tile(np.arange(STEP), -(-count // STEP))[:count]
    shared = np.where(first, shared, np.maximum(start, 0))
    extend(np.flatnonzero(asked & ~first & (shared < most)), most)
    return shared
