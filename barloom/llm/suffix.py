"""Suffix arrays and common prefixes of byte strings, in numpy."""

from __future__ import annotations

import numpy as np

from . import arrays as A

CURSORS = 8192


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Positions in the order of the bytes from there on.

    Larsson-Sadakane: after sorting by seven bytes (and by length, for those the end
    cuts off), groups of equal suffixes are refined by the rank of the suffix h
    further on, h doubling each round; settled groups are left alone.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    key = A.lanes(A.padded(data))[:n].byteswap()
    key &= ~np.uint64(255)
    key |= np.minimum(np.arange(n, 0, -1), 7).astype(np.uint64)
    order = np.argsort(key)
    key = key[order]
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(head, n))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.repeat(head, size)
    open_ = np.flatnonzero(np.repeat(size > 1, size))  # places whose order is not settled
    h = 7
    while len(open_) and h < n:
        at = order[open_]
        key = rank[at] * (n + 2) + rank[np.minimum(at + h, n)] + 1
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[open_] = at
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(start, len(at)))
        rank[at] = np.repeat(open_[start], size)
        open_ = open_[np.repeat(size > 1, size)]
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place of the suffix array, the common prefix with the place before, up to ``most``.

    Kasai: in text order the common prefix shrinks by one at most from position to
    position. Many cursors do so at once, each over its own stretch of the text, and
    compare eight bytes a step.
    """
    n = len(order)
    if n == 0:
        return np.zeros(0, np.int64)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    view = A.lanes(np.concatenate([data, np.zeros(most + 16, np.uint8)]))
    stretch = -(-n // CURSORS)
    prefix = np.zeros(n, np.int64)
    at = np.arange(0, n, stretch)
    length = np.zeros(len(at), np.int64)
    for _ in range(stretch):
        other = before[at]
        length = np.maximum(length - 1, 0)
        room = np.minimum(most, n - np.maximum(at, other))
        length[other < 0] = 0
        going = np.flatnonzero((other >= 0) & (length < room))
        while len(going):
            i = length[going]
            differ = view[at[going] + i] ^ view[other[going] + i]
            same = differ == 0
            # equal low bytes: the lowest set bit tells how many
            bit = np.log2((differ & (~differ + np.uint64(1))).astype(np.float64), where=~same, out=np.full(len(i), 64.0))
            i += (bit.astype(np.int64)) >> 3
            length[going] = np.minimum(i, room[going])
            going = going[same & (i < room[going])]
        length = np.minimum(length, room)
        prefix[at] = length
        at = at + 1
        inside = at < n
        if not inside.all():
            at, length = at[inside], length[inside]
    return prefix[order]


def repeated_starts(data: np.ndarray, starts: np.ndarray, weight: np.ndarray, length: int):
    """Groups of equal strings of ``length`` bytes at the given starts: (start, group, weight of the group).

    ``starts`` must have ``length`` bytes left. Starts come in suffix order.
    """
    order = suffix_array(data)
    prefix = common_prefixes(data, order, length)
    given = np.full(len(data), -1, np.int64)
    given[starts] = np.arange(len(starts))
    place = np.flatnonzero(given[order] >= 0)
    which = given[order[place]]
    # the common prefix of two starts is the smallest between their places
    new = np.ones(len(place), bool)
    if len(place) > 1:
        new[1:] = np.minimum.reduceat(prefix[: place[-1] + 1], place[:-1] + 1) < length
    group = np.cumsum(new) - 1
    total = np.bincount(group, weight[which]).astype(np.int64) if len(place) else np.zeros(0, np.int64)
    return starts[which], group, total[group]
