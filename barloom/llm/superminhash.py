"""SuperMinHash signatures of many sets at once, in numpy.

Each element has a pseudo-random permutation of the slots (Fisher-Yates, drawn one
step a level) and a pseudo-random fraction at each level. At level l it offers
``l + fraction`` to the l-th slot of its permutation; a slot keeps the smallest offer.
Offers of later levels cannot beat a slot that is filled, so a set stops as soon as
all its slots are (early stopping): after one or two levels for a set of several
hundred elements.
"""

from __future__ import annotations

import numpy as np

from . import arrays as A

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_EMPTY = np.uint64(2**64 - 1)


def _draw(elements: np.ndarray, level: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(place in the permutation to swap with, offer) at one level."""
    x = A.mix(elements + np.uint64((level + 1) * int(_STEP) % 2**64))
    place = level + (((x >> np.uint64(32)) * np.uint64(slots - level)) >> np.uint64(32)).astype(np.int64)
    return place, (np.uint64(level) << np.uint64(32)) | (x & _LOW)


def signatures(elements: np.ndarray, row: np.ndarray, rows: int, slots: int) -> np.ndarray:
    """(rows, slots) signatures; ``row`` gives each element's set. An empty set keeps empty slots."""
    out = np.full(rows * slots, _EMPTY, dtype=np.uint64)
    place, offer = _draw(elements, 0, slots)
    np.minimum.at(out, row * slots + place, offer)
    grid = out.reshape(rows, slots)
    has = np.zeros(rows, bool)
    has[row] = True
    unfilled = has & (grid == _EMPTY).any(axis=1)
    on = unfilled[row]
    elements, row, place = elements[on], row[on], place[on]
    order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(row), 1))
    every = np.arange(len(row))
    order[every, place] = 0
    order[:, 0] = place
    for level in range(1, slots):
        if not len(row):
            break
        place, offer = _draw(elements, level, slots)
        every = np.arange(len(row))
        slot = order[every, place]
        order[every, place] = order[:, level]
        order[:, level] = slot
        np.minimum.at(out, row * slots + slot, offer)
        unfilled = has & (grid == _EMPTY).any(axis=1)
        on = unfilled[row]
        if not on.all():
            elements, row, order = elements[on], row[on], order[on]
    return grid


def bands(grid: np.ndarray, width: int) -> np.ndarray:
    """(rows, slots / width) hashes of the bands of each signature."""
    rows, slots = grid.shape
    out = np.empty((rows, slots // width), dtype=np.uint64)
    for b in range(slots // width):
        h = np.full(rows, b + 1, dtype=np.uint64)
        for k in range(b * width, (b + 1) * width):
            h = A.mix(h * _STEP + grid[:, k])
        out[:, b] = h
    return out
