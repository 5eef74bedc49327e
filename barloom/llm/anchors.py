"""Content-defined anchors: equal long strings choose equal anchors, wherever they stand."""

from __future__ import annotations

import numpy as np

from . import arrays as A

GRAM = 32
_POSITION_BITS = 23
BLOCK_STARTS = 1 << 22


def gram_hashes(buffer: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the 32 bytes from each of the first ``n`` positions of a buffer padded by 32 bytes or more."""
    h = A.lanes(buffer)[: n + 24] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    for step in (8, 16):
        h = (h[:-step] ^ (h[step:] * np.uint64(0xBF58476D1CE4E5B9))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
    return h[:n]


def _window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive entries, in log2(width) passes."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def segments(raw: np.ndarray, offsets: np.ndarray, length: int):
    """The anchored segments of some texts: (text, first start, starts, anchor offset, anchor hash).

    Every string of ``length`` bytes has one anchor: the position of the smallest hash
    among its 32-byte grams, the leftmost of equal ones. A segment is a run of starts in
    one text with the same anchor; it covers ``starts + length - 1`` bytes. Only starts
    whose string ends inside the text belong to a segment. ``raw`` is at most a few
    million bytes (see ``blocks``).
    """
    none = np.zeros(0, np.int64)
    n = len(raw) - length + 1
    if n <= 0:
        return none, none, none, none, np.zeros(0, np.uint64)
    width = length - GRAM + 1
    buffer = np.zeros(len(raw) + 64, np.uint8)
    buffer[: len(raw)] = raw
    grams = gram_hashes(buffer, n + width - 1)
    low = np.uint64((1 << _POSITION_BITS) - 1)
    keyed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_window_minimum(keyed, width) & low).astype(np.int64)
    size = np.diff(offsets)
    inside = np.zeros(n + 1, np.int32)
    long = size >= length
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - length + 1, -1)
    inside = np.cumsum(inside[:n]) > 0
    begins = inside.copy()
    # a text's first start begins a segment even if the text before it ends with the same anchor
    begins[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    begins[offsets[:-1][long]] = True
    first = np.flatnonzero(begins)
    edges = np.flatnonzero(begins | ~inside)
    past = np.append(edges, n)[np.searchsorted(edges, first, side="right")]
    text = np.searchsorted(offsets, first, side="right") - 1
    return text, first - offsets[text], past - first, anchor[first] - first, grams[anchor[first]]


def blocks(size: int, length: int, most: int = BLOCK_STARTS):
    """(first, past) byte ranges that share the starts of a text of ``size`` bytes among themselves."""
    for first in range(0, max(1, size - length + 1), most):
        yield first, min(size, first + most + length - 1)
