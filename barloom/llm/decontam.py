"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Every window of ``width`` consecutive words of a benchmark item (the whole item
when it is shorter, but not empty) goes into a set that all tasks get. Documents
are scanned once: word hashes, window hashes, a bit filter, the exact hash list,
then each hit is compared word by word.

The set is broadcast only up to ``block_bytes``. A larger benchmark is cut by
hash into blocks of about that size, and the documents pass one block after the
other, carrying their hits in two columns, written to the shared folder in between.

Defined cases: null or wordless texts have no words and no hits; items without
words have no windows; an item without an id counts as the empty id; repeated items
and items of equal id count once by id; an empty benchmark hits nothing. Columns of
the documents pass through untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .store import stored

WIDTH = 10
BLOCK_BYTES = 32 << 20
FILTER_BITS = 22
WORDS, HITS, ITEMS = "_bd_words", "_bd_hits", "_bd_items"


def _tokens(raw: np.ndarray, offsets: np.ndarray):
    """(padded lower-cased bytes, start, end, row) of the words of some texts."""
    buffer = A.padded(raw, lower=True)
    return buffer, *A.spans(A.ALNUM[buffer[: len(raw)]], offsets)


def benchmark_grams(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item, n, gram) of every window of every item; ``gram`` is its words joined by blanks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, grams = [], [], []
            raw, offsets = A.text_bytes(batch.column("t"))
            buffer, start, end, row = _tokens(raw, offsets)
            bounds = A.run_starts(row, batch.num_rows)
            for i, name in enumerate(batch.column("i").to_pylist()):
                words = [buffer[s:e].tobytes() for s, e in zip(start[bounds[i] : bounds[i + 1]], end[bounds[i] : bounds[i + 1]])]
                n = min(width, len(words))
                for k in range(len(words) - n + 1 if n else 0):
                    names.append(name)
                    sizes.append(n)
                    grams.append(b" ".join(words[k : k + n]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(sizes, pa.int32()), pa.array(grams, pa.binary())], ["item", "n", "gram"]
            )

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").alias("t"))
    return named.mapInArrow(cut, "item string, n int, gram binary").distinct()


class GramSet:
    """One block of windows: hashes sorted by width, their words, the items they stand in."""

    def __init__(self, rows: list[tuple[str, int, bytes]]):
        items: dict[bytes, list[str]] = {}
        sizes: dict[bytes, int] = {}
        for item, n, gram in rows:
            items.setdefault(gram, []).append(item)
            sizes[gram] = n
        self.widths = {}
        for n in sorted(set(sizes.values())):
            grams = sorted(g for g, k in sizes.items() if k == n)
            joined = np.frombuffer(b" ".join(grams), dtype=np.uint8)
            buffer = A.padded(joined)
            start, end, _ = A.spans(A.ALNUM[joined], np.array([0, len(joined)]))
            hashes = A.window_hashes(A.span_hashes(buffer, start, end), n)[::n]
            order = np.argsort(hashes)
            flags = np.zeros(1 << FILTER_BITS, dtype=bool)
            flags[hashes >> np.uint64(64 - FILTER_BITS)] = True
            self.widths[n] = (hashes[order], [grams[i] for i in order], [items[grams[i]] for i in order], flags)

    def scan(self, raw: np.ndarray, offsets: np.ndarray):
        """(words, hit runs, items) for each text; a run is the first and one past the last word."""
        rows = len(offsets) - 1
        buffer, start, end, row = _tokens(raw, offsets)
        bounds = A.run_starts(row, rows)
        depth = np.zeros(len(start) + 1, dtype=np.int32)
        found: dict[int, set[str]] = {}
        hashes = A.span_hashes(buffer, start, end)
        for n, (known, grams, items, flags) in self.widths.items():
            windows = A.window_hashes(hashes, n)
            if not len(windows):
                continue
            at = np.flatnonzero(flags[windows >> np.uint64(64 - FILTER_BITS)] & (row[: len(windows)] == row[n - 1 :]))
            place = np.searchsorted(known, windows[at])
            same = known[np.minimum(place, len(known) - 1)] == windows[at]
            for i, k in zip(at[same].tolist(), place[same].tolist()):
                text = b" ".join(buffer[s:e].tobytes() for s, e in zip(start[i : i + n], end[i : i + n]))
                while k < len(known) and known[k] == windows[i]:
                    if grams[k] == text:
                        depth[i] += 1
                        depth[i + n] -= 1
                        found.setdefault(int(row[i]), set()).update(items[k])
                    k += 1
        hit = np.cumsum(depth[:-1]) > 0
        first, past, _ = A.spans(hit, bounds)
        in_row = np.searchsorted(bounds, first, side="right") - 1
        runs: list[list[int]] = [[] for _ in range(rows)]
        for r, a, b in zip(in_row.tolist(), first.tolist(), past.tolist()):
            runs[r] += (a - int(bounds[r]), b - int(bounds[r]))
        return np.diff(bounds), runs, [sorted(found.get(r, ())) for r in range(rows)]


def _united(runs: list[int], more: list[int]) -> list[int]:
    """Two flat lists of runs as one, in order and without overlap."""
    pairs = sorted(list(zip(runs[::2], runs[1::2])) + list(zip(more[::2], more[1::2])))
    out: list[int] = []
    for a, b in pairs:
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += (a, b)
    return out


def _scan_block(docs: DataFrame, rows: list[tuple[str, int, bytes]]) -> DataFrame:
    spark = docs.sparkSession
    grams = spark.sparkContext.broadcast(rows)
    schema = T.StructType(docs.schema.fields[:])
    if WORDS not in docs.columns:
        schema = schema.add(WORDS, "long").add(HITS, T.ArrayType(T.LongType())).add(ITEMS, T.ArrayType(T.StringType()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = GramSet(grams.value)
        for batch in batches:
            raw, offsets = A.text_bytes(batch.column("text"))
            words, hits, items = [], [], []
            for a, b in A.chunks(offsets):
                w, h, i = known.scan(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                words += w.tolist()
                hits += h
                items += i
            fields = {n: batch.column(n) for n in batch.schema.names}
            if HITS in fields:
                hits = [_united(x, y) if x else y for x, y in zip(fields[HITS].to_pylist(), hits)]
                items = [sorted({*x, *y}) for x, y in zip(fields[ITEMS].to_pylist(), items)]
            fields |= {
                WORDS: pa.array(words, pa.int64()),
                HITS: pa.array(hits, pa.list_(pa.int64())),
                ITEMS: pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays(list(fields.values()), list(fields))

    return docs.mapInArrow(scan, schema)


def mark(docs: DataFrame, items: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the columns of this module: word count, hit word runs, items hit."""
    grams = stored(benchmark_grams(items, width), "grams")
    total = grams.agg(F.sum(F.octet_length("gram") + F.octet_length("item") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for k in range(blocks):
        # a block is about block_bytes large, whatever the benchmark's size
        block = grams.filter(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == k)
        docs = _scan_block(docs, [(r.item, r.n, bytes(r.gram)) for r in block.toLocalIterator()])
        if k < blocks - 1:
            docs = stored(docs, "marked")
    return docs


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "documents", width: int = WIDTH) -> DataFrame:
    """``docs`` without contamination: ``remove`` whole "documents", or only the hit "spans".

    A span reaches from the first to the last letter of a run of hit words.
    """
    marked = mark(docs, items, width)
    if remove == "documents":
        return marked.filter(F.size(HITS) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, runs in enumerate(batch.column(HITS).to_pylist()):
                if runs:
                    raw = np.frombuffer(texts[i].encode(), dtype=np.uint8)
                    _, start, end, _ = _tokens(raw, np.array([0, len(raw)]))
                    keep = np.ones(len(raw), dtype=bool)
                    for a, b in zip(runs[::2], runs[1::2]):
                        keep[start[a] : end[b - 1]] = False
                    texts[i] = raw[keep].tobytes().decode()
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names], names
            )

    return marked.mapInArrow(cut, docs.schema)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and items of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    marked = mark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate(
        F.sequence(F.lit(0), F.size(HITS) - 2, F.lit(2)),
        F.lit(0).cast("long"),
        lambda total, i: total + F.get(HITS, i + 1) - F.get(HITS, i),
    )
    return marked.select(
        "doc_id",
        F.col(WORDS).alias("n_words"),
        F.when(F.size(HITS) == 0, F.lit(0).cast("long")).otherwise(n_hit).alias("n_hit"),
        F.size(ITEMS).cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join(F.sort_array(ITEMS), ","), "UTF-8"), 256).alias("items_sha256"),
        (F.size(HITS) > 0).alias("contaminated"),
    )


_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE_OP2 = f"""
with item as (select coalesce(cast(item_id as varchar), '') as item, {_SQL_WORDS} as w from benchmark),
sized as (select item, w, least(10, len(w)) as n from item where len(w) > 0),
gram as (
  select distinct item, n, array_to_string(w[k : k + n - 1], ' ') as gram
  from (select item, w, n, unnest(range(1, len(w) - n + 2)) as k from sized)
),
doc as (select doc_id, {_SQL_WORDS} as w from documents),
win as (
  select doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') as gram
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k
        from doc, (select distinct n from gram) where len(w) >= n)
),
hit as (select win.doc_id, win.n, win.k, gram.item from win join gram using (gram)),
word as (select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(k, k + n)) as p from (select distinct doc_id, n, k from hit)) group by 1),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct doc_id, item from hit) group by 1)
select doc.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, n_hit is not null as contaminated
from doc left join word using (doc_id) left join items using (doc_id)
"""
