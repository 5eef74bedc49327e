"""Byte-level BPE encoding and decoding by a file of ranks.

A text is cut by the tokenizer's pattern; each piece that is no token itself is
merged. Pieces of a batch are merged together: distinct pieces of about equal
length are the rows of a padded numpy matrix, and in every round each row merges
its leftmost pair of the lowest rank, found in a hash table of pairs. Rows without
any pair left are compacted away.

Pieces over 64 bytes would cost the square of their length that way. They stand one after
the other in a flat row with links to the neighbours; cells wait in a bucket a rank, and a
round takes the lowest rank's bucket and updates only the cells it touches. Occurrences of
one pair go together, of overlapping ones every other from the left, as long as the order
cannot matter: a merge that brings no lower rank next to it is followed by the next
occurrence; one that does is followed by lower-ranked tokens that contain it, which reach
as far as the longest of them. So of occurrences that stand within reach of each other,
those up to the first that brings a lower rank go in one round.

A task keeps the ids of frequent pieces in a cache of bounded size; that only saves
time, every piece is encoded by the same rounds.

Defined cases: a null text is an empty one and has no ids. Special tokens are
ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

CACHE_PIECES = 250_000
LONG_PIECE = 64
MATRIX_CELLS = 1 << 18
ROWS_A_STEP = 256
_NO_RANK = np.int64(1) << 40
_ENDED = np.iinfo(np.int32).max


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank, from a file of base64 words and numbers."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class PairTable:
    """Open-addressing hash table from a pair of ids to the id of its merged token."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, int(np.ceil(np.log2(2 * len(pairs) + 2))))
        size = 1 << self.bits
        self.keys = np.full(size, -1, dtype=np.int64)
        self.ids = np.full(size, _NO_RANK, dtype=np.int64)
        keys = np.array([(a << 32) | b for a, b in pairs], dtype=np.int64)
        ids = np.array(list(pairs.values()), dtype=np.int64)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]  # of several, the last one stays
            took = self.keys[slot] == keys
            self.ids[slot[took]] = ids[took]
            keys, ids, slot = keys[~took], ids[~took], (slot[~took] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the merged tokens; a very large number where there is none."""
        keys = (left.astype(np.int64) << 32) | right
        slot = self._slot(keys)
        out = np.full(keys.shape, _NO_RANK, dtype=np.int64)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        flat_keys, flat_slot = keys.ravel()[open_], slot.ravel()[open_]
        flat_out = out.ravel()
        while len(open_):
            there = self.keys[flat_slot]
            hit = there == flat_keys
            flat_out[open_[hit]] = self.ids[flat_slot[hit]]
            on = ~hit & (there != -1)
            open_, flat_keys = open_[on], flat_keys[on]
            flat_slot = (flat_slot[on] + 1) & (len(self.keys) - 1)
        return flat_out.reshape(keys.shape)


class Codec:
    """Encoder and decoder for one file of ranks and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.tokens = dict(sorted((r, t) for t, r in ranks.items()))
        self.bytes_to_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs, wholes = {}, {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
                    for part in {a, b}:
                        wholes.setdefault(part, []).append(rank)
        self.pairs = PairTable(pairs)
        # bytes of the longest token of lower rank that an id may grow into by lower ranks alone
        self.reach = np.zeros(max(self.tokens, default=0) + 1, dtype=np.int64)
        for rank in self.tokens:
            seen, todo = set(), [rank]
            while todo:
                lower = {w for w in wholes.get(todo.pop(), ()) if w < rank} - seen
                seen |= lower
                todo += lower
            if seen:
                self.reach[rank] = max(len(self.tokens[w]) for w in seen)
        self.cache: dict[str, bytes] = {}

    def _merge_bucket(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces of about equal length, merged as the rows of one matrix.

        ``grid`` has a row a piece, its ids from the left, and at least one empty last
        column; ``merged`` has the merged id of each pair of neighbours.
        """
        width = max(map(len, pieces))
        grid = np.full((len(pieces), width + 1), -1, dtype=np.int64)
        inside = np.arange(width + 1) < np.array([len(p) for p in pieces])[:, None]
        grid[inside] = self.bytes_to_id[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        done: list[bytes] = [b""] * len(pieces)
        names = np.arange(len(pieces))
        merged = self.pairs.get(grid[:, :-1], grid[:, 1:])
        while len(names):
            at = np.argmin(merged, axis=1)  # the leftmost of the lowest
            best = merged[np.arange(len(names)), at]
            open_ = best < _NO_RANK
            if not open_.all():
                ended = grid[~open_]
                kept = ended >= 0
                flat = ended[kept].astype("<u4").tobytes()
                ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
                for name, a, b in zip(names[~open_].tolist(), [0, *ends], ends):
                    done[name] = flat[a:b]
                names, grid, merged, at, best = (x[open_] for x in (names, grid, merged, at, best))
                if not len(names):
                    break
            grid, merged = self._merge_one(grid, merged, at, best)
        return done

    def _merge_one(self, grid, merged, at, best):
        """Each row's pair becomes one id; what stands to its right moves one to the left."""
        rows, column = np.arange(len(grid)), np.arange(grid.shape[1])
        from_ = np.minimum(column + (column > at[:, None]), grid.shape[1] - 1)
        grid[rows, at] = best
        grid = np.take_along_axis(grid, from_, axis=1)
        merged = np.take_along_axis(merged, np.minimum(from_[:, :-1], merged.shape[1] - 1), axis=1)
        merged[rows, at] = self.pairs.get(best, grid[rows, at + 1])
        inner = np.flatnonzero(at > 0)
        merged[inner, at[inner] - 1] = self.pairs.get(grid[inner, at[inner] - 1], best[inner])
        return grid, merged

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.minimum(self.pairs.get(left, right), _ENDED).astype(np.int32)

    def _merge_long(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of long pieces, merged in one flat row with an empty cell after each piece."""
        text = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
        borders = np.cumsum([len(p) + 1 for p in pieces]) - 1
        n = len(text)
        ids = self.bytes_to_id.astype(np.int32)[text]
        ids[borders] = -1
        after, before = np.arange(1, n + 1, dtype=np.int64), np.arange(-1, n - 1, dtype=np.int64)
        rank = np.full(n, _ENDED, dtype=np.int32)
        waiting: dict[int, array] = {}
        ranks_left: list[int] = []

        def wait(cells: np.ndarray) -> None:
            new = self._rank_of(ids[cells], ids[after[cells]])
            rank[cells] = new
            open_ = new < _ENDED
            for r, cell in zip(new[open_].tolist(), cells[open_].tolist()):
                if r in waiting:
                    waiting[r].append(cell)
                else:
                    waiting[r] = array("q", (cell,))
                    heapq.heappush(ranks_left, r)

        for first in range(0, n - 1, MATRIX_CELLS):
            wait(np.arange(first, min(first + MATRIX_CELLS, n - 1), dtype=np.int64))
        while ranks_left:
            r = heapq.heappop(ranks_left)
            at = np.unique(np.frombuffer(waiting.pop(r), dtype=np.int64))
            at = at[rank[at] == r]
            if not len(at):
                continue
            # every other of those that overlap, from the left of each run
            heads = np.flatnonzero(np.r_[True, after[at[:-1]] != at[1:]])
            place = np.arange(len(at)) - np.repeat(heads, np.diff(np.r_[heads, len(at)]))
            rest, at = at, at[place % 2 == 0]
            if self.reach[r] and len(at) > 1:
                at = at[self._go_at_once(r, at, ids, after, before)]
            gone = after[at]
            far = after[gone]
            ids[at], ids[gone], rank[gone] = r, -1, _ENDED
            after[at], before[far] = far, at
            near = before[at]
            wait(np.unique(np.r_[near[near >= 0], at]))
            rest = rest[rank[rest] == r]
            if len(rest):
                waiting[r] = array("q", rest.tobytes())
                heapq.heappush(ranks_left, r)
        done, first = [], 0
        for end in borders.tolist():
            row = ids[first:end]
            done.append(row[row >= 0].astype("<u4").tobytes())
            first = end + 1
        return done

    def _go_at_once(self, r, at, ids, after, before) -> np.ndarray:
        """Which of the cells ``at`` may merge to ``r`` in one round, see above."""
        gone = after[at]
        left = np.where(before[at] >= 0, ids[before[at]], -1)
        left[1:][after[gone[:-1]] == at[1:]] = r  # its neighbour went just before
        merged = np.full(len(at), r, dtype=np.int64)
        lower = np.minimum(self.pairs.get(left, merged), self.pairs.get(merged, ids[after[gone]])) < r
        before_it = np.cumsum(lower) - lower
        far_off = np.r_[True, np.diff(at) >= 2 * self.reach[r]]
        return before_it == np.maximum.accumulate(np.where(far_off, before_it, 0))

    def _encode_new(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces; those that are no token go to the matrices by length."""
        raws = [p.encode() for p in pieces]
        out: dict[str, bytes] = {}
        rest = []
        for i, rank in enumerate(map(self.ranks.get, raws)):
            if rank is None:
                rest.append(i)
            else:
                out[pieces[i]] = rank.to_bytes(4, "little")
        sizes = np.array([len(raws[i]) for i in rest], dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        rest, sizes = np.array(rest, dtype=np.int64)[order].tolist(), sizes[order]
        i = 0
        while i < len(rest):
            # lengths of a bucket differ by a quarter at most, and its matrix is bounded
            j = int(np.searchsorted(sizes, sizes[i] * 5 // 4, side="right"))
            long = sizes[i] > LONG_PIECE
            if long:  # a flat row has no padding
                j = int(np.searchsorted(np.cumsum(sizes[i:]), MATRIX_CELLS, side="right")) + i
            j = max(i + 1, min(j, i + MATRIX_CELLS // int(sizes[i])))
            merge = self._merge_long if long else self._merge_bucket
            for k, ids in zip(rest[i:j], merge([raws[k] for k in rest[i:j]])):
                out[pieces[k]] = ids
            i = j
        return out

    def encode_batch(self, texts: list[str], batch_chars: int = 1 << 20) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= batch_chars):
                size += len(texts[j])
                j += 1
            pieces = [self.split(t) for t in texts[i:j]]
            known = self.cache
            new = list({p for ps in pieces for p in ps if p not in known})
            if len(known) + len(new) > CACHE_PIECES:
                known = {}
                new = list({p for ps in pieces for p in ps})
            known.update(self._encode_new(new))
            for ps in pieces:
                yield b"".join(map(known.__getitem__, ps))
            self.cache = known if len(known) <= CACHE_PIECES else {}
            i = j

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_CODECS: dict[tuple[str, str], Codec] = {}


def _codec(name: str, pattern: str) -> Codec:
    """One codec a Python worker; the file was sent to all executors by Spark."""
    if (name, pattern) not in _CODECS:
        _CODECS[name, pattern] = Codec(read_ranks(SparkFiles.get(name)), pattern)
    return _CODECS[name, pattern]


def _mapped(docs: DataFrame, ranks_path: str, pattern: str, make, schema) -> DataFrame:
    spark = docs.sparkSession
    spark.sparkContext.addFile(ranks_path)
    name = ranks_path.rpartition("/")[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(name, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_A_STEP):
                yield make(codec, batch.slice(first, ROWS_A_STEP))
        codec.cache = {}  # the worker may serve other work next

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ``ids`` (binary, little-endian unsigned 32-bit) of every row's text."""

    def make(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = list(codec.encode_batch([t or "" for t in batch.column("text").to_pylist()]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return _mapped(rows, ranks_path, pattern, make, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the decoded bytes of every row of ids."""

    def make(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [codec.decode(i) for i in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return _mapped(encoded, ranks_path, pattern, make, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes decoded from them."""

    def make(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, ids_sha, decoded_sha = [], [], []
        for ids in codec.encode_batch([t or "" for t in batch.column("text").to_pylist()]):
            sizes.append(len(ids) // 4)
            ids_sha.append(hashlib.sha256(ids).hexdigest())
            decoded_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return _mapped(rows, ranks_path, pattern, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every whole document, as digests."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
