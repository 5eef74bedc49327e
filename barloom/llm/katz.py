"""Katz backoff language model of order two, counted, stored and evaluated by Spark.

Words are 64-bit hashes; a text is its words and one end, and the end is also what the
first word follows. Counts are discounted after Good and Turing up to ``CUT`` (a
fixed small amount above it, so that every context keeps something for words it was
not seen with); what is left is spread over the words not seen there, in proportion to
their unigram probability. Backoff weights are normalised exactly: for every context
the probabilities of all known words and of one unknown word add up to 1.

The model is three tables in partitions: ``bigrams`` (word, context, count),
``unigrams`` (word, count), ``contexts`` (context, count, alpha).

How the corpus meets the model without moving a row a token:

1. texts are packed into blocks of some megabytes, written once;
2. each block sends every partition of the model one request: its distinct bigrams there
   and how often its training texts hold them. A bigram belongs to its word's partition;
   bigrams of very frequent words are dealt by both words;
3. a partition adds the requests up, writes its part of the model, and answers each block
   with whole counts only, in the order of its request;
4. a block with all its answers evaluates its tokens: seen bigrams at once, others by the
   unigram and a backoff weight that is joined by context.

Defined cases: a null text is an empty one, a single end; rows without id are training
texts; without training texts every token has probability 1.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A
from .store import stored

CUT = 5
ABOVE = 0.1
BLOCK_BYTES = 6 << 20
PART_BYTES = 6 << 20
HOT_SHARE = 0.002
END = np.uint64(0x0E0D0E0D0E0D0E0D)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


# ---- small arrays as bytes


def _pack(values: np.ndarray, kind: str, increasing: bool = False) -> bytes:
    """An array, its bytes sorted by weight and compressed."""
    values = np.asarray(values).astype(kind)
    if increasing and len(values):
        values = np.concatenate([values[:1], values[1:] - values[:-1]])
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(data: bytes, kind: str, increasing: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    width = np.dtype(kind).itemsize
    values = np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel() if len(planes) else np.zeros(0, kind)
    return np.cumsum(values, dtype=kind) if increasing else values


# ---- blocks


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(block, ids, held, texts): rows of whole texts, about ``block_bytes`` of them packed in each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        squeeze = zstandard.ZstdCompressor(level=1).compress
        rows: list[tuple] = []
        size = 0

        def made() -> pa.RecordBatch:
            nonlocal number
            number += 1
            texts = [t for _, _, t in rows]
            body = pickle.dumps((np.cumsum([0, *map(len, texts)]), b"".join(texts)))
            return pa.RecordBatch.from_arrays(
                [pa.array([number - 1]), pa.array([[i for i, _, _ in rows]], pa.list_(pa.int64())),
                 pa.array([[h for _, h, _ in rows]], pa.list_(pa.bool_())), pa.array([squeeze(body)], pa.binary())],
                ["block", "ids", "held", "texts"],
            )

        for batch in batches:
            raw, offsets = A.text_bytes(batch.column("text"))
            ids, held = batch.column("doc_id").to_pylist(), batch.column("held").to_pylist()
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                rows.append((ids[i], held[i], raw[a:b].tobytes()))
                size += b - a + 64
                if size >= block_bytes:
                    yield made()
                    rows, size = [], 0
        if rows:
            yield made()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held"), "text")
    return rows.mapInArrow(pack, "block long, ids array<long>, held array<boolean>, texts binary")


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in order, the place of each value among them)."""
    one, place = np.unique(values, return_inverse=True)
    return one, place.astype(np.int32)


class Block:
    """The tokens of one block: distinct words and bigrams, and where they stand."""

    def __init__(self, held: list[bool], texts: bytes, bigrams: bool = True):
        offsets, joined = pickle.loads(zstandard.ZstdDecompressor().decompress(texts))
        raw = np.frombuffer(joined, dtype=np.uint8)
        hashes, rows = [], []
        for a, b in A.chunks(offsets):
            buffer = A.padded(raw[offsets[a] : offsets[b]], lower=True)
            inner = offsets[a : b + 1] - offsets[a]
            start, end, row = A.spans(A.NOT_SPACE[buffer[: inner[-1]]], inner)
            # one end after the words of each text
            place = A.run_starts(row, b - a)[1:]
            hashes.append(np.insert(A.span_hashes(buffer, start, end), place, END))
            rows.append((np.insert(row, place, np.arange(b - a)) + a).astype(np.int32))
        self.row = np.concatenate(rows)
        self.n_rows = len(held)
        self.train = ~np.array(held, dtype=bool)
        self.words, self.word = _coded(np.concatenate(hashes))
        if not bigrams:
            return
        first = np.append(True, self.row[1:] != self.row[:-1])
        end_id = np.searchsorted(self.words, END)
        self.context = np.where(first, end_id, np.append(0, self.word[:-1])).astype(np.int32)
        # distinct bigrams, ordered by word, then context
        self.pairs, self.pair = _coded(self.word * np.int64(len(self.words)) + self.context)
        in_train = self.train[self.row]
        self.pair_train = np.bincount(self.pair[in_train], minlength=len(self.pairs))
        self.word_train = np.bincount(self.word[in_train], minlength=len(self.words))

    def parts(self, parts: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(partition of each word, which words are hot, partition of each bigram)."""
        of_word = (A.mix(self.words) % np.uint64(parts)).astype(np.int64)
        is_hot = np.isin(self.words, hot)
        word, context = np.divmod(self.pairs, len(self.words))
        both = A.mix(self.words[word] ^ A.mix(self.words[context]))
        return of_word, is_hot, np.where(is_hot[word], (both % np.uint64(parts)).astype(np.int64), of_word[word])


# ---- requests, counts, answers


def _hot_words(blocks: DataFrame) -> np.ndarray:
    """Words that make up ``HOT_SHARE`` of some block or more, the thousand most frequent of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, texts in zip(batch.column("held").to_pylist(), batch.column("texts").to_pylist()):
                block = Block(held, texts, bigrams=False)
                n = np.bincount(block.word, minlength=len(block.words))
                often = n >= max(2, HOT_SHARE * len(block.word))
                yield pa.RecordBatch.from_arrays([pa.array(block.words[often].view(np.int64)), pa.array(n[often])], ["w", "n"])

    # a thousand words say where bigrams go; no result depends on which
    found = blocks.mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n"), "w").limit(1000).collect()
    return np.sort(np.array([r.w for r in rows], dtype=np.int64).view(np.uint64))


def _requests(blocks: DataFrame, parts: int, hot) -> DataFrame:
    """(part, block, request): what one block asks of one partition, and brings to it."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, held, texts in zip(*(batch.column(c).to_pylist() for c in ("block", "held", "texts"))):
                block = Block(held, texts)
                of_word, is_hot, of_pair = block.parts(parts, hot.value)
                word, context = np.divmod(block.pairs, len(block.words))
                by_part = np.argsort(of_pair, kind="stable")
                borders = np.searchsorted(of_pair[by_part], np.arange(parts + 1))
                bodies = []
                for p in range(parts):
                    own = by_part[borders[p] : borders[p + 1]]
                    new = np.flatnonzero(np.append(True, word[own][1:] != word[own][:-1])) if len(own) else np.zeros(0, int)
                    contexts, at = np.unique(context[own], return_inverse=True)
                    mine = np.flatnonzero(is_hot & (of_word == p))
                    bodies.append(pickle.dumps((
                        _pack(block.words[word[own][new]], "<u8", True),
                        _pack(np.diff(np.append(new, len(own))), "<i4"),
                        _pack(block.words[contexts], "<u8", True),
                        _pack(at, "<i4"),
                        _pack(block.pair_train[own], "<i4"),
                        _pack(block.words[mine], "<u8", True),
                        _pack(block.word_train[mine], "<i8"),
                    )))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(parts), pa.int32()), pa.array([name] * parts), pa.array(bodies, pa.binary())],
                    ["part", "block", "request"],
                )

    return blocks.mapInArrow(ask, "part int, block long, request binary")


_KINDS = "kind string, part int, word long, context long, n long, word_n long, block long, answer binary"


def _counted(table: pa.Table) -> pa.Table:
    """One partition of the model, and its answers."""
    table = table.sort_by("block")
    part = table.column("part")[0].as_py()
    read = []
    for body in table.column("request").to_pylist():
        words, runs, contexts, at, train, hot, hot_train = pickle.loads(body)
        words, contexts, hot = (_unpack(x, "<u8", True) for x in (words, contexts, hot))
        read.append((words, _unpack(runs, "<i4"), contexts, _unpack(at, "<i4"), _unpack(train, "<i4"), hot, _unpack(hot_train, "<i8")))
    all_words = np.unique(np.concatenate([r[0] for r in read]))
    all_contexts = np.unique(np.concatenate([r[2] for r in read]))
    keys = [
        np.repeat(np.searchsorted(all_words, w), runs) * np.int64(len(all_contexts)) + np.searchsorted(all_contexts, c)[at]
        for w, runs, c, at, _, _, _ in read
    ]
    pairs, pair = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(pair, np.concatenate([r[4] for r in read]), len(pairs)).astype(np.int64)
    word = pairs // max(1, len(all_contexts))
    word_n = np.bincount(word, n, len(all_words)).astype(np.int64)
    hot_words = np.unique(np.concatenate([r[5] for r in read]))
    hot_n = np.zeros(len(hot_words), np.int64)
    for r in read:
        hot_n[np.searchsorted(hot_words, r[5])] += r[6]
    answers, done = [], 0
    for (w, _, _, at, _, hot, _), key in zip(read, keys):
        own = pair[done : done + len(key)]
        done += len(key)
        answers.append(pickle.dumps((
            _pack(n[own], "<i8"),
            _pack(word_n[np.searchsorted(all_words, w)], "<i8"),
            _pack(hot_n[np.searchsorted(hot_words, hot)], "<i8"),
        )))
    seen, some, hots = np.flatnonzero(n), np.flatnonzero(word_n), np.flatnonzero(hot_n)
    signed = lambda x: x.view(np.int64)
    tables = [
        {"kind": "bigram", "word": signed(all_words)[word[seen]], "n": n[seen], "word_n": word_n[word[seen]],
         "context": signed(all_contexts)[pairs[seen] % max(1, len(all_contexts))]},
        # of hot words only some bigrams are here: their counts come from the hot list
        {"kind": "word", "word": signed(all_words)[some], "n": word_n[some]},
        {"kind": "hot", "word": signed(hot_words)[hots], "n": hot_n[hots]},
        {"kind": "answer", "block": table.column("block").to_numpy(), "answer": answers},
    ]
    kinds = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("word", pa.int64()), ("context", pa.int64()),
                       ("n", pa.int64()), ("word_n", pa.int64()), ("block", pa.int64()), ("answer", pa.binary())])
    out = []
    for t in tables:
        size = len(t["block" if "block" in t else "word"])
        t |= {"kind": pa.repeat(t["kind"], size), "part": pa.repeat(pa.scalar(part, pa.int32()), size)}
        out.append(pa.table([pa.array(t[f.name], f.type) if f.name in t else pa.nulls(size, f.type) for f in kinds], schema=kinds))
    return pa.concat_tables(out)


# ---- discounts and backoff


def discounts(of_counts: dict[int, int]) -> list[float]:
    """Factors for counts 1 to ``CUT`` from the numbers of entries with count 1 to CUT + 1.

    Good-Turing in Katz's form; where the numbers do not allow it (one is missing, or a factor
    leaves the range) an absolute discount takes its place. All stay below 1 - ABOVE / r.
    """
    n = [of_counts.get(r, 0) for r in range(CUT + 2)]
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    out = []
    common = (CUT + 1) * n[CUT + 1] / n[1] if n[1] else 1.0
    for r in range(1, CUT + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common < 1 else -1.0
        if not 0 < d < 1:
            d = (r - min(absolute, 0.9)) / r
        out.append(min(d, 1 - ABOVE / r))
    return out


def _discounted(n: np.ndarray, factors: list[float]) -> np.ndarray:
    """Discounted counts; 0 stays 0."""
    table = np.array([0.0, *((r + 1) * d for r, d in enumerate(factors))])
    return np.where(n > CUT, n - ABOVE, table[np.minimum(n, CUT)])


def _discounted_column(n: str, factors: list[float]) -> Column:
    low = F.element_at(F.array(*[F.lit((r + 1) * d) for r, d in enumerate(factors)]), F.least(F.col(n), F.lit(CUT)).cast("int"))
    return F.when(F.col(n) > CUT, F.col(n) - ABOVE).otherwise(low)


def _of_counts(table: DataFrame) -> tuple[dict[int, int], int, int]:
    """(entries by count up to CUT + 1, entries, sum of counts)."""
    rows = table.groupBy(F.least("n", F.lit(CUT + 1)).alias("r")).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s")).collect()
    return {r.r: r.k for r in rows}, sum(r.k for r in rows), sum(r.s for r in rows)


class Katz:
    """The stored model: three tables and the numbers that go with them."""

    def __init__(self, docs: DataFrame, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES):
        spark = docs.sparkSession
        self.block_bytes = block_bytes
        self.blocks = stored(_blocks(docs, block_bytes), "blocks")
        total = self.blocks.agg(F.sum(F.octet_length("texts"))).first()[0] or 0
        self.parts = int(total // (part_bytes // 2)) + 1  # texts are packed to about half
        self.hot = spark.sparkContext.broadcast(_hot_words(self.blocks))  # a thousand numbers at most
        requests = _requests(self.blocks, self.parts, self.hot)
        counted = stored(requests.groupBy("part").applyInArrow(_counted, _KINDS), "katz", "kind", "part")
        self.answers = counted.filter("kind = 'answer'").select("block", "part", "answer")
        self.bigrams = counted.filter("kind = 'bigram'").select("word", "context", "n", "word_n")
        hot = F.broadcast(counted.filter("kind = 'hot'").select("word", F.col("n").alias("hot_n")))
        words = counted.filter("kind = 'word'").select("word", "n")
        self.unigrams = words.join(hot, "word", "left_anti").unionAll(
            counted.filter("kind = 'hot'").select("word", "n")
        )
        of_words, self.types, self.tokens = _of_counts(self.unigrams)
        of_pairs, _, _ = _of_counts(self.bigrams)
        self.word_factors, self.pair_factors = discounts(of_words), discounts(of_pairs)
        # what the unigram model gives to the unknown word
        self.unknown = self.tokens - sum(k * (r * self.word_factors[r - 1] if r <= CUT else 0) for r, k in of_words.items() if r <= CUT)
        above = self.tokens - sum(r * k for r, k in of_words.items() if r <= CUT)
        self.unknown -= above - ABOVE * of_words.get(CUT + 1, 0)
        probability = _discounted_column("word_n", self.word_factors) / F.lit(float(max(1, self.tokens)))
        pairs = (
            self.bigrams.join(hot, "word", "left")
            .withColumn("word_n", F.coalesce("hot_n", "word_n"))
            .select("context", "n", (F.col("n") - _discounted_column("n", self.pair_factors)).alias("left"), probability.alias("p"))
        )
        contexts = pairs.groupBy("context").agg(F.sum("n").alias("n"), F.sum("left").alias("left"), F.sum("p").alias("p"))
        self.contexts = stored(
            contexts.select("context", "n", (F.col("left") / F.col("n") / (1 - F.col("p"))).alias("alpha")), "contexts"
        )

    def score(self) -> DataFrame:
        """doc_id, held_out, token counts, base_score and score of every text."""
        spark, parts, hot, types, tokens = self.blocks.sparkSession, self.parts, self.hot, self.types, self.tokens
        word_factors, pair_factors, unknown = self.word_factors, self.pair_factors, float(self.unknown)
        # the weights of hot words, a thousand at most, go to every block; the others are joined
        names = spark.createDataFrame([(int(w),) for w in hot.value.view(np.int64)], "context long")
        weights = {r.context: r.alpha for r in self.contexts.join(F.broadcast(names), "context").select("context", "alpha").collect()}
        weights = spark.sparkContext.broadcast(weights)
        kinds = [("block", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                 ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("context", pa.int64()), ("times", pa.int64())]

        def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name, ids, held, texts, answers in zip(*(batch.column(c) for c in ("block", "ids", "held", "texts", "answers"))):
                    block = Block(held.as_py(), texts.as_py())
                    pair_n, word_n = _answered(block, answers.as_py(), parts, hot.value)
                    total = float(max(1, tokens))
                    p_word = np.zeros(len(word_n))
                    if tokens:
                        p_word = np.log10(np.where(word_n > 0, _discounted(word_n, word_factors), unknown) / total)
                    seen = pair_n[block.pair] > 0
                    context_n = word_n[block.context]  # a context is counted as often as its word
                    score = p_word[block.word]
                    score[seen] = np.log10(_discounted(pair_n[block.pair[seen]], pair_factors) / context_n[seen])
                    base = np.log10((word_n + 0.5) / (tokens + 0.5 * (types + 1)))[block.word]
                    # what backs off needs its context's weight, unless the context is new as well
                    back = np.flatnonzero(~seen & (context_n > 0))
                    weight = np.array([weights.value.get(w, np.nan) for w in block.words.view(np.int64).tolist()])[block.context[back]]
                    have = ~np.isnan(weight)
                    score[back[have]] += np.log10(weight[have])
                    back = back[~have]
                    key = block.row[back] * np.int64(len(block.words)) + block.context[back]
                    key, times = np.unique(key, return_counts=True)
                    per_row = lambda x: np.bincount(block.row, x, block.n_rows)
                    rows = {
                        "row": np.arange(block.n_rows), "doc_id": ids.values, "held_out": ~block.train,
                        "n_tokens": np.bincount(block.row, minlength=block.n_rows),
                        "n_known": per_row(word_n[block.word] > 0).astype(np.int64),
                        "base_score": per_row(base), "score": per_row(score),
                    }
                    asks = {"row": key // len(block.words), "context": block.words.view(np.int64)[key % len(block.words)], "times": times}
                    for part, n in ((rows, block.n_rows), (asks, len(key))):
                        part["block"] = np.full(n, name.as_py())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(part[c], k) if c in part else pa.nulls(n, k) for c, k in kinds], [c for c, _ in kinds]
                        )

        shape = (
            "block long, row long, doc_id long, held_out boolean, n_tokens long, n_known long, "
            "base_score double, score double, context long, times long"
        )
        answers = self.answers.groupBy("block").agg(F.collect_list(F.struct("part", "answer")).alias("answers"))
        found = stored(self.blocks.join(answers, "block").mapInArrow(evaluate, shape), "scores")
        missing = (
            found.filter("context is not null")
            .join(self.contexts, "context")
            .groupBy("block", "row")
            .agg(F.sum(F.col("times") * F.log10("alpha")).alias("more"))
        )
        return (
            found.filter("context is null")
            .join(missing, ["block", "row"], "left")
            .select(
                "doc_id", "held_out", "n_tokens", "n_known",
                F.lit(tokens).cast("long").alias("train_tokens"),
                "base_score",
                (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
            )
        )


    def score_texts(self, docs: DataFrame) -> DataFrame:
        """The columns of ``score`` for the rows (doc_id, text) of any frame, by joins with the stored tables.

        The model stays as it is; ``held_out`` says what the id would have been. Each text sends a
        row for each of its distinct bigrams; hot words are left to the adaptive skew join.
        """
        tokens = float(max(1, self.tokens))
        blocks = stored(_blocks(docs, self.block_bytes), "asked")
        asked = blocks.mapInArrow(_bigrams_of_rows, "block long, row long, doc_id long, held_out boolean, word long, context long, times long")
        found = (
            asked.join(self.bigrams.select("word", "context", F.col("n").alias("pair_n")), ["word", "context"], "left")
            .join(self.unigrams.withColumnRenamed("n", "word_n"), "word", "left")
            .join(self.contexts.withColumnRenamed("n", "context_n"), "context", "left")
        )
        known = F.coalesce("word_n", F.lit(0))
        p_word = F.when(known > 0, _discounted_column("word_n", self.word_factors)).otherwise(float(self.unknown)) / tokens
        back = F.coalesce("alpha", F.lit(1.0)) * p_word
        p = F.when(F.col("pair_n") > 0, _discounted_column("pair_n", self.pair_factors) / F.col("context_n")).otherwise(back)
        p = p if self.tokens else F.lit(1.0)
        base = (known + 0.5) / (self.tokens + 0.5 * (self.types + 1))
        times = F.col("times")
        return (
            found.groupBy("block", "row", "doc_id", "held_out")
            .agg(
                F.sum(times).alias("n_tokens"),
                F.sum(F.when(known > 0, times).otherwise(0)).alias("n_known"),
                F.lit(self.tokens).cast("long").alias("train_tokens"),
                F.sum(times * F.log10(base)).alias("base_score"),
                F.sum(times * F.log10(p)).alias("score"),
            )
            .drop("block", "row")
        )


def _bigrams_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct bigrams of every text of some blocks and how often they stand in it."""
    for batch in batches:
        for name, ids, held, texts in zip(*(batch.column(c) for c in ("block", "ids", "held", "texts"))):
            block = Block(held.as_py(), texts.as_py())
            key, times = np.unique(block.row * np.int64(len(block.pairs)) + block.pair, return_counts=True)
            signed = block.words.view(np.int64)
            for first in range(0, len(key), 1 << 16):
                row, pair = np.divmod(key[first : first + (1 << 16)], len(block.pairs))
                word, context = np.divmod(block.pairs[pair], len(block.words))
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(name, len(row)), pa.array(row), ids.values.take(pa.array(row)), pa.array(~block.train[row]),
                     pa.array(signed[word]), pa.array(signed[context]), pa.array(times[first : first + (1 << 16)])],
                    ["block", "row", "doc_id", "held_out", "word", "context", "times"],
                )


def _answered(block: Block, answers: list[dict], parts: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Training counts of the block's distinct bigrams and words."""
    of_word, is_hot, of_pair = block.parts(parts, hot)
    pair_n, word_n = np.zeros(len(block.pairs), np.int64), np.zeros(len(block.words), np.int64)
    word = block.pairs // len(block.words)
    by_part = np.argsort(of_pair, kind="stable")
    borders = np.searchsorted(of_pair[by_part], np.arange(parts + 1))
    whole = []
    for answer in answers:
        p = answer["part"]
        own = by_part[borders[p] : borders[p + 1]]
        pairs, words, hots = (_unpack(x, "<i8") for x in pickle.loads(answer["answer"]))
        pair_n[own] = pairs
        word_n[np.unique(word[own])] = words
        whole.append((np.flatnonzero(is_hot & (of_word == p)), hots))
    for mine, hots in whole:  # last: a hot word's bigrams are counted in many places
        word_n[mine] = hots
    return pair_n, word_n


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under the model of those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return Katz(docs).score()
