"""Suffix arrays of one shard of bytes by induced sorting, and permuted common prefixes.

A suffix is of type S if it is smaller than the one after it, else of type L; an S suffix after an L
suffix is a leftmost S suffix. Once the leftmost S suffixes are in order, one scan over the buckets of
first bytes induces the order of all L suffixes from them, and one scan back that of all S suffixes.
Scans go bucket by bucket: everything a bucket induces is moved in a few array operations, and a bucket
that induces into itself is scanned again for the new entries only.

The leftmost S suffixes are put in order by the same method. A first pair of scans sorts the substrings
between them, equal substrings get one name, and the string of names, at most half as long, is sorted
in turn. Names are many where texts vary; then its suffixes are ranked by doubling, since going through
buckets of one or two entries each would be no gain.
"""

from __future__ import annotations

import numpy as np

# Strings with more symbols than this are ranked by doubling.
BUCKETS = 512
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def suffix_types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes. The last symbol is the single smallest one and of type S."""
    step = np.sign(np.diff(s.astype(np.int64)))
    # A run of equal symbols has the type of the first difference after it.
    at = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(at[::-1])[::-1]
    rises = np.append(step, 1)[following] > 0
    return np.append(rises, True)


def _spread(symbols: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How to lay entries out by symbol, in their order: (order, place inside its symbol, counts)."""
    # Sixteen bits are sorted by radix.
    order = np.argsort(symbols.astype(np.uint16), kind="stable")
    counts = np.bincount(symbols, minlength=size)
    starts = np.cumsum(counts) - counts
    return order, np.arange(len(symbols)) - starts[symbols[order]], counts


def induce(s: np.ndarray, is_s: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    """All suffixes in order, given the leftmost S suffixes in order."""
    n = len(s)
    total = np.bincount(s, minlength=size)
    smalls = np.bincount(s[is_s], minlength=size)
    begin = np.cumsum(total) - total
    s_begin, end = begin + total - smalls, begin + total
    out = np.full(n, -1, np.int64)

    # L suffixes from the front: a bucket holds its L suffixes first.
    head = begin.copy()
    by_symbol, place, counts = _spread(s[seeds], size)
    seeds_in_order, seed_end = seeds[by_symbol], np.cumsum(counts)

    def push_front(entries: np.ndarray) -> None:
        before = entries[entries > 0] - 1
        before = before[~is_s[before]]
        if len(before):
            symbols = s[before]
            order, inside, counts = _spread(symbols, size)
            out[head[symbols[order]] + inside] = before[order]
            np.add(head, counts, out=head)

    for c in np.flatnonzero(total):
        done = begin[c]
        while done < head[c]:
            done, new = head[c], out[done : head[c]]
            push_front(new)
        own = seeds_in_order[seed_end[c] - counts[c] : seed_end[c]]
        if len(own):
            push_front(own)

    # S suffixes from the back; places count down from the end of a bucket.
    tail = end.copy()

    def push_back(entries: np.ndarray) -> None:
        before = entries[entries > 0] - 1
        before = before[is_s[before]]
        if len(before):
            symbols = s[before]
            order, inside, counts = _spread(symbols, size)
            out[tail[symbols[order]] - 1 - inside] = before[order]
            np.subtract(tail, counts, out=tail)

    last = s[n - 1]
    out[end[last] - 1] = n - 1
    tail[last] -= 1
    for c in np.flatnonzero(total)[::-1]:
        done = end[c]
        while done > tail[c]:
            done, new = tail[c], out[tail[c] : done][::-1]
            push_back(new)
        push_back(out[begin[c] : s_begin[c]][::-1])
    return out


def _ranked_by_doubling(s: np.ndarray) -> np.ndarray:
    """The suffixes of a string in order: ranks of pairs of ranks until all differ."""
    n, reach = len(s), 1
    rank = s.astype(np.int64)
    while True:
        second = np.zeros(n, np.int64)
        second[:-reach] = rank[reach:] + 1
        pair = rank * (n + 2) + second
        order = np.argsort(pair)
        new = np.empty(n, np.int64)
        new[order] = np.append(0, np.cumsum(pair[order][1:] != pair[order][:-1]))
        if new[order[-1]] == n - 1 or reach * 2 >= n:
            return order
        rank, reach = new, reach * 2


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The order of all suffixes of ``s``: whole numbers from 0, whose last one is the only 0."""
    n, size = len(s), int(s.max()) + 1
    if n <= 2:
        return np.arange(n)[::-1].copy()
    if size > BUCKETS:
        return _ranked_by_doubling(s)
    is_s = suffix_types(s)
    leftmost = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    sorted_once = induce(s, is_s, leftmost, size)
    marked = np.zeros(n, bool)
    marked[leftmost] = True
    in_order = sorted_once[marked[sorted_once]]
    # A substring goes from one leftmost S suffix to the next one, both included.
    until = np.full(n, n - 1)
    until[leftmost[:-1]] = leftmost[1:]
    new = np.append(True, ~_equal_substrings(s, is_s, in_order, until))
    names = np.empty(n, np.int64)
    names[in_order] = np.cumsum(new) - 1
    reduced = names[leftmost]
    if new.all():
        seeds = in_order
    else:
        seeds = leftmost[suffix_array(reduced)]
    return induce(s, is_s, seeds, size)


def _equal_substrings(s: np.ndarray, is_s: np.ndarray, order: np.ndarray, until: np.ndarray) -> np.ndarray:
    """Whether each leftmost S substring, in ``order``, equals the one before it, types included."""
    symbols = (s.astype(np.uint64) * np.uint64(2) + is_s + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    symbols ^= symbols >> np.uint64(32)
    powers = np.cumprod(np.append(np.uint64(1), np.full(len(s) - 1, BASE)), dtype=np.uint64)
    sums = np.append(np.uint64(0), np.cumsum(symbols * powers, dtype=np.uint64))
    first, last = order, until[order] + 1
    length = last - first
    # Sums over [first, last), each shifted to the larger of the two starting powers.
    a, b = first[:-1], first[1:]
    sum_a, sum_b = sums[last[:-1]] - sums[a], sums[last[1:]] - sums[b]
    top = np.maximum(a, b)
    same = sum_a * powers[top - a] == sum_b * powers[top - b]
    return same & (length[:-1] == length[1:])


def permuted_common_prefixes(s: np.ndarray, order: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(before, common): for each position the suffix sorted before it and the length of their common
    prefix, which ends where either one's text does (``left``: symbols to the end of the text).

    Where the symbols before both are equal the prefix is one shorter than that of the position
    before, so only the other positions are compared, eight symbols at a time.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    position = np.arange(n)
    reducible = (position > 0) & (before > 0)
    reducible[1:] &= s[:-1] == s[before[1:] - 1]
    # A text's first position begins anew, since ``left`` jumps there.
    reducible[1:] &= (left[1:] == left[:-1] - 1) & (left[before[1:]] == left[before[1:] - 1] - 1)
    words = np.zeros(n, np.uint64)
    padded = np.append(s, np.zeros(8, s.dtype)).astype(np.uint64)
    for k in range(8):
        words |= (padded[k : n + k] & np.uint64(255)) << np.uint64(8 * k)
    common = np.zeros(n, np.int64)
    active = np.flatnonzero(~reducible & (before >= 0))
    other = before[active]
    most = np.minimum(left[active], left[other])
    done = np.zeros(len(active), np.int64)
    live = np.arange(len(active))
    while len(live):
        a = active[live] + done[live]
        b = other[live] + done[live]
        # Past the end nothing is compared: ``most`` cuts there.
        differ = words[np.minimum(a, n - 1)] ^ words[np.minimum(b, n - 1)]
        lowest = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.log2(np.maximum(lowest, np.uint64(1)).astype(float)).astype(np.int64) // 8)
        done[live] += equal
        live = live[(equal == 8) & (done[live] < most[live])]
    common[active] = np.minimum(done, most)
    source = np.maximum.accumulate(np.where(reducible, 0, position))
    return before, np.where(before >= 0, common[source] - (position - source), 0)
