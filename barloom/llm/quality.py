"""Quality rules: gradient-boosted trees over document statistics.

Statistics come from vector passes over the bytes of many texts. Trees are grown on
histograms with logistic loss, second-order gains and monotonic constraints, and kept
as flat node arrays, so a batch is scored by ``depth`` gathers a tree.

The model is fitted on at most ``max_fit_rows`` labelled rows (those with the smallest
hash of their id, the same at every run); everything else covers all rows.

Defined cases: a null text has no words, so its base rules fail; rows without a
usable label (0 or 1) are not fitted; with no label, or one kind only, the trees
are empty and every document that passes the base rules is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A

MAX_FIT_ROWS = 20_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Feature and sign of its constraint: -1 where more of it may only lower the score.
FEATURES = {
    "log_words": 0,
    "mean_word_chars": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_word_share": -1,
    "distinct_word_share": 0,
    "upper_share": -1,
    "digit_share": 0,
    "mark_share": 0,
    "words_per_line": 0,
    "top_word_share": 0,
    "letter_share": 0,
}

_CONTINUATION = A.byte_class([*range(0x80, 0xC0)])
_SYMBOL = A.byte_class(b"#*$%&|<>")
_UPPER = A.byte_class([*range(65, 91)])
_DIGIT = A.byte_class([*range(48, 58)])
_MARK = A.byte_class(b"!?|_=+/\\{}[]()@^~")
_LETTER = A.byte_class([*range(65, 91), *range(97, 123), *range(0xC0, 256)])
_LINE = ~A.byte_class(b"\n")


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums between offsets; empty ranges give 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def statistics(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts, features) of some texts, one row a text."""
    rows = len(offsets) - 1
    buffer = A.padded(raw)
    solid = A.NOT_SPACE[raw]
    start, end, row = A.spans(solid, offsets)
    bounds = A.run_starts(row, rows)
    n_words = np.diff(bounds)
    word_chars = _sums(solid & ~_CONTINUATION[raw], offsets)
    symbols = _sums(_SYMBOL[raw], offsets)

    line_start, line_end, line_row = A.spans(_LINE[raw], offsets)
    solid_before = np.concatenate([[0], np.cumsum(solid, dtype=np.int64)])
    with_word = solid_before[line_end] > solid_before[line_start]
    line_start, line_end, line_row = line_start[with_word], line_end[with_word], line_row[with_word]
    _, first = A.counts_within(line_row, A.span_hashes(buffer, line_start, line_end))
    lines = np.bincount(line_row, minlength=rows)
    dup_lines = lines - np.bincount(line_row[first], minlength=rows)

    hashes = A.span_hashes(buffer, start, end)
    windows = A.window_hashes(hashes, 3)
    at = np.flatnonzero(row[: len(windows)] == row[2:]) if len(windows) else np.zeros(0, np.int64)
    times, _ = A.counts_within(row[at], windows[at])
    again = at[times > 1]
    depth = np.zeros(len(start) + 1, dtype=np.int64)
    np.add.at(depth, again, 1)
    np.add.at(depth, again + 3, -1)
    repeated = _sums(np.cumsum(depth[:-1]) > 0, bounds)

    times, first = A.counts_within(row, hashes)
    distinct = np.bincount(row[first], minlength=rows)
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, row, times)

    counts = np.stack([n_words, word_chars, symbols, dup_lines, repeated], axis=1)
    words, chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    features = np.stack(
        [
            np.log1p(n_words),
            word_chars / words,
            symbols / words,
            dup_lines / np.maximum(lines, 1),
            repeated / words,
            distinct / words,
            _sums(_UPPER[raw], offsets) / chars,
            _sums(_DIGIT[raw], offsets) / chars,
            _sums(_MARK[raw], offsets) / chars,
            n_words / np.maximum(lines, 1),
            top / words,
            _sums(_LETTER[raw], offsets) / chars,
        ],
        axis=1,
    )
    return counts, features


@dataclass
class Trees:
    """Boosted trees as node arrays; a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[rows, self.feature[node]] <= self.limit[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    signs: list[int],
    rounds: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 48,
    least: float = 5.0,
    ridge: float = 1.0,
) -> Trees:
    """Newton boosting on quantile bins.

    A split on a constrained feature must not order its children's values against
    the sign, and the middle of both values bounds everything below either child,
    which keeps the whole model monotone.
    """
    nodes: dict[str, list] = {k: [] for k in ("feature", "limit", "left", "right", "value")}
    roots: list[int] = []
    share = float(np.mean(y)) if len(y) else 1.0
    if not 0 < share < 1:
        prior = 10.0 if share >= 1 else -10.0
        return Trees(np.zeros(0, int), *(np.zeros(0) for _ in range(5)), 0, prior)
    edges = [np.unique(np.quantile(f, np.linspace(0, 1, bins + 1)[1:-1])) for f in x.T]
    binned = np.stack([np.searchsorted(e, f, side="left") for e, f in zip(edges, x.T)], axis=1)
    prior = float(np.log(share / (1 - share)))
    total = np.full(len(y), prior)

    def node(value: float) -> int:
        k = len(nodes["value"])
        for name, v in (("feature", 0), ("limit", np.inf), ("left", k), ("right", k), ("value", value)):
            nodes[name].append(v)
        return k

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        clipped = lambda a, b: np.clip(-a / (b + ridge), low, high)
        sum_g, sum_h = g[rows].sum(), h[rows].sum()
        value = float(clipped(sum_g, sum_h))
        k = node(value * rate)
        if level == depth:
            return k
        gain = lambda a, b, v: -(a * v + 0.5 * (b + ridge) * v * v)
        best = (1e-6, -1, -1, 0.0, 0.0)
        for f, edge in enumerate(edges):
            if not len(edge):
                continue
            at = binned[rows, f]
            left_g = np.cumsum(np.bincount(at, g[rows], len(edge) + 1))[:-1]
            left_h = np.cumsum(np.bincount(at, h[rows], len(edge) + 1))[:-1]
            a, b = clipped(left_g, left_h), clipped(sum_g - left_g, sum_h - left_h)
            won = gain(left_g, left_h, a) + gain(sum_g - left_g, sum_h - left_h, b) - gain(sum_g, sum_h, value)
            won[(left_h < least) | (sum_h - left_h < least) | ((b - a) * signs[f] < 0)] = -1
            j = int(np.argmax(won))
            if won[j] > best[0]:
                best = (won[j], f, j, a[j], b[j])
        _, f, j, a, b = best
        if f < 0:
            return k
        middle = (a + b) / 2
        below = (low, middle) if signs[f] > 0 else (middle, high) if signs[f] < 0 else (low, high)
        above = (middle, high) if signs[f] > 0 else (low, middle) if signs[f] < 0 else (low, high)
        goes_left = binned[rows, f] <= j
        nodes["feature"][k], nodes["limit"][k] = f, float(edges[f][j])
        nodes["left"][k] = grow(rows[goes_left], g, h, level + 1, *below)
        nodes["right"][k] = grow(rows[~goes_left], g, h, level + 1, *above)
        return k

    trees = Trees(np.zeros(0, int), *(np.zeros(0) for _ in range(5)), depth, prior)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
        trees = Trees(
            np.array(roots),
            *(np.array(nodes[n], dtype=int if n in ("feature", "left", "right") else float)
              for n in ("feature", "limit", "left", "right", "value")),
            depth,
            prior,
        )
        newest = Trees(trees.roots[-1:], trees.feature, trees.limit, trees.left, trees.right, trees.value, depth, 0.0)
        logit = np.clip(newest.score(x), 1e-12, 1 - 1e-12)
        total += np.log(logit / (1 - logit))
    return trees


def _per_text(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = A.text_bytes(batch.column("text"))
    parts = [
        statistics(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in A.chunks(offsets)
    ]
    if not parts:
        return np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate([c for c, _ in parts]), np.concatenate([f for _, f in parts])


def fit(docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS) -> Trees:
    """Trees from the labelled rows with the smallest hashes, at most ``max_fit_rows`` of them."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("quality")]
    chosen = known.select("doc_id", F.col("quality").cast("int").alias("_q_label")).distinct()
    chosen = chosen.orderBy(order[0], "doc_id", "_q_label").limit(max_fit_rows)
    names = list(FEATURES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, features = _per_text(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), *(pa.array(f) for f in features.T)],
                ["doc_id", "label", *names],
            )

    rows = (
        # the sample is bounded by max_fit_rows, so it can be broadcast
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", F.col("_q_label").alias("label"), "text")
        .mapInArrow(measure, "doc_id long, label int, " + ", ".join(f"{n} double" for n in names))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label", *names)
        .limit(max_fit_rows)
        .toPandas()
    )
    return fit_trees(rows[names].to_numpy(float), rows["label"].to_numpy(float), list(FEATURES.values()))


def assess(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, the counts, base_failed, the trees' score and kept for every row of ``docs``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features = _per_text(batch)
            failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])
            score = trees.score(features)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(c) for c in counts.T),
                    pa.array(failed),
                    pa.array(~failed & (score >= 0.5)),
                    pa.array(score),
                ],
                ["doc_id", *COUNTS, "base_failed", "kept", "score"],
            )

    shape = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, score double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(measure, shape)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    trees = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return assess(docs, trees)
