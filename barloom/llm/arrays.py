"""Numpy kernels over the UTF-8 bytes of many texts at once.

A batch of texts is one byte array and an offset array, as Arrow stores it, so
tokenising and hashing cost a few vector passes and no Python loop per word.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 1 << 20
LONG_WORD = 1 << 12
_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xBF58476D1CE4E5B9)
_K3 = np.uint64(0x94D049BB133111EB)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)

SPACES = b" \t\n\x0b\x0c\r"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(members: bytes | list[int]) -> np.ndarray:
    """A table of 256 flags."""
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(bytes(members), dtype=np.uint8)] = True
    return table


#: Bytes of words that are cut at white space only.
NOT_SPACE = ~byte_class(SPACES)
#: Bytes of words made of digits, lower-case letters and all that is not ASCII.
ALNUM = byte_class([*range(48, 58), *range(97, 123), *range(128, 256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= _K2
    x ^= x >> np.uint64(27)
    x *= _K3
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def released() -> None:
    """Gives free memory back to the system: a worker outlives its task and serves later stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def trimmed(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task over batches that leaves no memory behind."""

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            released()

    return run


def spans(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the runs of true flags; no run crosses a text."""
    n = len(flags)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inner = offsets[(offsets > 0) & (offsets < n)]
    begins = flags.copy()
    begins[1:] &= ~flags[:-1]
    begins[inner] = flags[inner]
    ends = flags.copy()
    ends[:-1] &= ~flags[1:]
    ends[inner - 1] = flags[inner - 1]
    start = np.flatnonzero(begins)
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, np.flatnonzero(ends) + 1, row


def padded(raw: np.ndarray, lower: bool = False) -> np.ndarray:
    """A copy with eight spare bytes, lower-cased (A-Z) on demand."""
    out = np.zeros(len(raw) + 8, dtype=np.uint8)
    out[: len(raw)] = LOWER[raw] if lower else raw
    return out


def lanes(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number; ``buffer`` is padded."""
    return np.ndarray(shape=(len(buffer) - 7,), dtype="<u8", buffer=buffer, strides=(1,))


def span_hashes(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans of a padded buffer, eight bytes a step."""
    length = end - start
    view = lanes(buffer)
    out = length.astype(np.uint64) * _K1
    # the longest first, so that those still open are always a prefix
    order = np.argsort(-length, kind="stable")
    size, at, h = length[order], start[order], out[order]
    long = int(np.searchsorted(-size, -LONG_WORD, side="left"))
    for i in range(long):
        h[i] = xxhash.xxh3_64_intdigest(buffer[at[i] : at[i] + size[i]].tobytes())
    done, open_ = 0, len(size)
    while True:
        open_ = int(np.searchsorted(-size[:open_], -done, side="left"))
        if open_ <= long:
            break
        part = slice(long, open_)
        lane = view[at[part] + done] & _MASKS[np.minimum(size[part] - done, 8)]
        x = (h[part] ^ lane) * _K2
        x ^= x >> np.uint64(29)
        h[part] = x * _K3 + np.uint64(done)
        done += 8
    out[order] = mix(h)
    return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` consecutive entries, one for every start."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = (out ^ hashes[k : k + n]) * _K2
        out ^= out >> np.uint64(32)
    return mix(out)


def run_starts(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each text's entries begin in a list ordered by text; length rows + 1."""
    return np.searchsorted(row, np.arange(rows + 1), side="left")


def counts_within(groups: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry how often its hash occurs in its group, and a flag on one entry of each."""
    if len(hashes) == 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    key = mix(hashes + groups.astype(np.uint64) * _K1)
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(key)))
    counts = np.empty(len(key), np.int64)
    counts[order] = np.repeat(size, size)
    one = np.empty(len(key), bool)
    one[order] = new
    return counts, one
