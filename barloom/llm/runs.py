"""Periodic runs of words, caught online at dyadic blocks.

A run is a stretch of words that are equal ``q`` words apart, at least ``times`` periods and
``least`` words long. Words arrive in order. For every power of two ``m`` each completed block
of ``m`` words has a catcher: the window of ``m`` words that an appended word completes is
compared with the one block that lies ``m`` to ``2m - 1`` words before it (1 to 16 words for
the smallest size). Equal means a repetition at that distance: a run of period ``q`` holds an
aligned block and its copy at distance ``q``, so none is missed. Comparisons of the longest
common suffix before the block and of the common prefix behind it stretch a catch to its
borders; catches of one stretch merge, the smallest period counts. Stretches that reach the
last word stay open and grow with the next words.

Many texts are one sequence with a word of its own behind each, so no run crosses a text, and
all windows that a call of ``append`` completes are compared in a few vector passes a size.
Windows are compared by prefix sums of a polynomial hash; every run is then checked word by
word. Words are 64-bit hashes. Time is n log n, also for texts of one repeated word.

Defined cases: a null text has no words and gives an empty text; a text without white space
is one word; repeated rows are treated alike, row by row; columns of the documents pass
through, only a column named like a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A

LEAST = 24
TIMES = 3
SLICE = 1 << 20
_SMALLEST = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.zeros((0, 3), np.int64)


class Catchers:
    """The runs of a growing sequence of 64-bit words, as rows (start, end, period).

    ``longest`` is the longest period that can occur, if known; larger blocks get no catcher.
    The smallest block holds eight words, which finds runs of 24 words or more.
    """

    def __init__(self, least: int = LEAST, times: int = TIMES, longest: int | None = None):
        if least < LEAST or times < TIMES:
            raise ValueError(f"runs of at least {LEAST} words and {TIMES} periods can be caught")
        self.least, self.times, self.longest = least, times, longest
        self.n = 0
        self._words = np.zeros(0, np.uint64)
        self._sums = np.zeros(1, np.uint64)
        self._powers = np.ones(1, np.uint64)
        self._open = _NONE
        self._settled = _NONE

    def _grow(self, new: np.ndarray) -> None:
        n = self.n + len(new)
        if n > len(self._words):
            room = max(n, 2 * len(self._words))
            for name, more in (("_words", 0), ("_sums", 1), ("_powers", 1)):
                old = getattr(self, name)
                grown = np.empty(room + more, np.uint64)
                grown[: self.n + more] = old[: self.n + more]
                setattr(self, name, grown)
        self._words[self.n : n] = new
        self._powers[self.n + 1 : n + 1] = _BASE
        np.cumprod(self._powers[self.n : n + 1], out=self._powers[self.n : n + 1])
        self._sums[self.n + 1 : n + 1] = A.mix(new.copy()) * self._powers[self.n : n]
        np.cumsum(self._sums[self.n : n + 1], out=self._sums[self.n : n + 1])
        self.n = n

    def _same(self, a: np.ndarray, b: np.ndarray, size) -> np.ndarray:
        """Whether the ``size`` words from ``a`` and from ``b`` on are equal; ``a`` is before ``b``."""
        left = (self._sums[a + size] - self._sums[a]) * self._powers[b - a]
        return left == self._sums[b + size] - self._sums[b]

    def _stretch(self, at: np.ndarray, q: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many words before ``at`` (step -1) or from ``at`` on (step 1) equal those ``q`` later, ``most`` at most."""
        low, high = np.zeros(len(at), np.int64), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            a = at - middle if step < 0 else at
            same = self._same(a, a + q, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def _catch(self, m: int, near: int, old: int) -> np.ndarray:
        """Squares of blocks of ``m`` words whose copies, ``near`` words away or more, were completed since ``old``."""
        s = np.arange(max(near, old - m + 1), self.n - m + 1)
        block = (s - near) // m * m
        hit = self._same(block, s, m)
        s, block = s[hit], block[hit]
        return np.stack([block, s - block], axis=1)

    def append(self, new: np.ndarray) -> np.ndarray:
        """Takes the next words; the runs that became long enough with them, as far as they reach now."""
        old = self.n
        self._grow(new)
        if not len(new):
            return _NONE
        before = self._settled
        stretches = [self._advanced()]
        m = _SMALLEST
        while m < self.n and (self.longest is None or m <= max(self.longest, _SMALLEST)):
            known = self._settle(np.concatenate(stretches))
            stretches = [known[1], known[2]]
            caught = [self._catch(m, m, old)] if m > _SMALLEST else [self._catch(m, 1, old), self._catch(m, 9, old)]
            found = self._bordered(np.concatenate(caught), m, known[1])
            stretches.append(found)
            m *= 2
        _, long, short = self._settle(np.concatenate(stretches))
        closed = long[:, 1] < self.n
        # a run that has reached the last word may go on, and is settled only for now
        self._settled = long
        self._open = np.concatenate([long[~closed], short[short[:, 1] == self.n]])
        told = {(a, q) for a, _, q in before.tolist()}
        return long[[(a, q) not in told for a, _, q in long.tolist()]]

    def _advanced(self) -> np.ndarray:
        """Settled runs, and open stretches as far as they reach now."""
        if not len(self._open):
            return self._settled
        start, end, q = self._open.T
        further = self._stretch(end - q, q, self.n - end, 1)
        grown = np.stack([start, end + further, q], axis=1)
        done = self._settled[~np.isin(self._settled[:, 1], end)] if len(self._settled) else _NONE
        return np.concatenate([done, grown])

    def _bordered(self, squares: np.ndarray, m: int, known: np.ndarray) -> np.ndarray:
        """Catches stretched to their borders; those inside a known run of a period up to ``m`` give nothing new."""
        if not len(squares):
            return _NONE
        block, q = squares.T
        known = known[known[:, 2] <= m]
        if len(known):
            known = known[np.argsort(known[:, 0])]
            reach = np.maximum.accumulate(known[:, 1])
            place = np.searchsorted(known[:, 0], block, side="right") - 1
            inside = (place >= 0) & (reach[np.maximum(place, 0)] >= block + q + m)
            block, q = block[~inside], q[~inside]
        order = np.lexsort((block, q))
        block, q = block[order], q[order]
        if not len(block):
            return _NONE
        # neighbouring blocks with copies at one distance are one stretch
        head = np.append(True, (q[1:] != q[:-1]) | (block[1:] != block[:-1] + m))
        first, q = block[head], q[head]
        last = block[np.append(np.flatnonzero(head)[1:], len(head)) - 1]
        start = first - self._stretch(first, q, first, -1)
        end = last + q + m
        end = end + self._stretch(last + m, q, self.n - end, 1)
        return np.stack([start, end, q], axis=1)

    def _settle(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(all, long, short) stretches: once each, with their smallest period; the long ones are checked word by word."""
        if not len(found):
            return _NONE, _NONE, _NONE
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        size = found[:, 1] - found[:, 0]
        enough = size >= np.maximum(self.least, self.times * found[:, 2])
        long, short = found[enough], found[~enough]
        if len(long):
            long = long[np.append(True, (long[1:, 0] != long[:-1, 0]) | (long[1:, 1] != long[:-1, 1]))]
            words = self._words
            false = [i for i, (a, b, q) in enumerate(long.tolist()) if not np.array_equal(words[a : b - q], words[a + q : b])]
            if false:
                true = [self._exact(*long[i].tolist()) for i in false]
                return self._settle(np.concatenate([np.delete(long, false, axis=0), short, *true]))
        return found, long, np.unique(short, axis=0)

    def _exact(self, a: int, b: int, q: int) -> np.ndarray:
        """What a stretch of equal hashes really holds: its parts whose words are equal ``q`` apart."""
        same = self._words[a : b - q] == self._words[a + q : b]
        start, end, _ = A.spans(same, np.array([0, len(same)]))
        return np.stack([start + a, end + a + q, np.full(len(start), q)], axis=1)

    def runs(self) -> np.ndarray:
        """All runs so far by start, then period."""
        return self._settled[np.lexsort((self._settled[:, 2], self._settled[:, 0]))]


def _texts_runs(words: np.ndarray, bounds: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, [start, end, period]) of all runs of some texts, given as words and where each text's begin."""
    rows = len(bounds) - 1
    sizes = np.diff(bounds)
    catchers = Catchers(least, times, longest=int(sizes.max(initial=0)) // times)
    row = np.repeat(np.arange(rows), sizes)
    stream = np.empty(len(words) + rows, np.uint64)
    stream[np.arange(len(words)) + row] = words
    stream[bounds[1:] + np.arange(rows)] = A.mix(np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for first in range(0, len(stream), SLICE):
        catchers.append(stream[first : first + SLICE])
    runs = catchers.runs()
    text = np.searchsorted(bounds[:-1] + np.arange(rows), runs[:, 0], side="right") - 1
    runs = runs.copy()
    runs[:, :2] -= (bounds[text] + text)[:, None]
    return text, runs


def _collapsed(buffer: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """Texts of the given words, joined by one blank."""
    bounds = A.run_starts(row, rows)
    size = end - start + 1
    size[bounds[1:][np.diff(bounds) > 0] - 1] -= 1
    offsets = np.concatenate([[0], np.cumsum(size)])
    total = int(offsets[-1])
    # behind each word the byte at its end is white space, and becomes a blank; the last of a text has none
    data = buffer[np.arange(total) + np.repeat(start - offsets[:-1], size)]
    blank = (offsets[1:] - 1)[size > end - start]
    data[blank] = 32
    text = pa.Array.from_buffers(
        pa.large_binary(), rows, [None, pa.py_buffer(offsets[bounds].astype(np.int64)), pa.py_buffer(data)]
    )
    return text.cast(pa.large_string()).cast(pa.string())


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    ``collapsed`` is the text's words joined by one blank, without those that a run holds
    behind its first period.
    """
    rest = [f for f in docs.schema.fields if f.name not in ("runs", "collapsed")]
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    shape = T.StructType([*rest, T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())])
    names = [f.name for f in rest]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = A.text_bytes(batch.column("text"))
            for a, b in A.chunks(offsets):
                part = raw[offsets[a] : offsets[b]]
                buffer = A.padded(part)
                start, end, row = A.spans(A.NOT_SPACE[part], offsets[a : b + 1] - offsets[a])
                bounds = A.run_starts(row, b - a)
                text, runs = _texts_runs(A.span_hashes(buffer, start, end), bounds, least, times)
                depth = np.zeros(len(start) + 1, np.int64)
                np.add.at(depth, bounds[text] + runs[:, 0] + runs[:, 2], 1)
                np.add.at(depth, bounds[text] + runs[:, 1], -1)
                keep = np.cumsum(depth[:-1]) == 0
                lists = pa.ListArray.from_arrays(
                    pa.array(A.run_starts(text, b - a).astype(np.int32)),
                    pa.StructArray.from_arrays(
                        [pa.array(runs[:, 0]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], ["start", "length", "period"]
                    ),
                )
                kept = _collapsed(buffer, start[keep], end[keep], row[keep], b - a)
                columns = [batch.column(c).slice(a, b - a) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, lists, kept], shape.names)

    return docs.mapInArrow(find, shape)


def stretched(docs: DataFrame) -> DataFrame:
    """``docs`` in which the texts of a tenth of the ids end in repetitions of their own words.

    With h the CRC-32 of the id and g = h // 10, the texts of h % 10 = 0 keep their first
    a = g % n words; after them p = 1 + (n - a) // (3 + g % 8) words go round. Rows without id stay.
    """
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.withColumn("_pr_words", F.when(h % 10 == 0, words)).withColumn("_pr_g", F.floor(h / 10))
    n = F.size("_pr_words").cast("long")
    docs = docs.withColumn("_pr_a", F.when(n > 0, F.expr("_pr_g % size(_pr_words)")))
    docs = docs.withColumn("_pr_p", F.expr("1 + (size(_pr_words) - _pr_a) div (3 + _pr_g % 8)"))
    rounds = F.expr(
        "array_join(transform(sequence(0L, size(_pr_words) - 1L), i -> "
        "_pr_words[cast(if(i < _pr_a, i, _pr_a + (i - _pr_a) % _pr_p) as int)]), ' ')"
    )
    docs = docs.withColumn("text", F.when(F.col("_pr_a").isNotNull(), rounds).otherwise(F.col("text")))
    return docs.drop("_pr_words", "_pr_g", "_pr_a", "_pr_p")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, the run of the greatest exponent, digests of all runs and of the collapsed text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_runs(stretched(docs))
    # runs are in order, so of equal exponents the first stays
    best = F.expr(
        "aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (b, r) -> "
        "if(b is null or r.length * b.period > b.length * r.period, r, b))"
    )
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("_pr_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_pr_best.start").alias("start"),
        F.col("_pr_best.length").alias("length"),
        F.col("_pr_best.period").alias("period"),
        F.expr("1000 * _pr_best.length div _pr_best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
