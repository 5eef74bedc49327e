"""Removal of long repeated byte strings with suffix arrays of bounded shards.

A byte goes if a string of ``length`` bytes covers it that starts anywhere else too. To
keep suffix arrays small and all equal strings together, every string is led to
its anchor (see ``anchors``), and a run of starts with one anchor is a segment:

1. segments are counted by anchor; an anchor that occurs once has no repeated string.
   Consecutive equal segments of a text (a run of one letter has one at every byte) are one
   row with a count;
2. equal segments of an anchor are merged into one with a weight;
3. the distinct segments go to shards of about ``shard_bytes`` by anchor. A shard's
   suffix array (Larsson-Sadakane) and common prefixes (Kasai) group equal strings; a
   group of weight two or more is repeated;
4. an anchor with more distinct segments than a shard holds is spread over several.
   Each writes its strings that are still single as sorted digests, cut by binary
   search at range borders; the slices of a range meet and are looked up in each
   other by binary search;
5. what is found goes back to all equal segments, and is cut out of their texts.

Texts move twice: compressed, next to the first occurrence's requests, into a scratch table
bucketed by document; all later steps join that table where it lies. Its buckets hold
about ``BUCKET_BYTES`` of text at most (more only where Spark allows no more buckets). All joins sort and spill.

Defined cases: a null text is an empty one; repeated rows repeat each other's strings;
a row without id is like any other; texts below ``length`` bytes keep everything.
Text columns lose bytes of a character that is cut in the middle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_table
from . import anchors
from . import arrays as A
from .store import stored
from .suffix import repeated_starts

LENGTH = 200
SHARD_BYTES = 2 << 20
CONTENT_BYTES = 4 << 20
BUCKET_BYTES = 128 << 20
CUT_ROWS = 500
KEY, MARK, PACKED, SPANS = "_br_key", "_br_mark", "_br_packed", "_br_spans"
ROW = [KEY, MARK]


def _marks(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each text; with the key it names a row."""
    data = memoryview(np.ascontiguousarray(raw))
    found = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    return np.array(found, dtype=np.uint64).view(np.int64)


def _key() -> F.Column:
    """The id as a number; without one another hash of the text, so that 128 bits name the row."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def _segments(docs: DataFrame, length: int) -> DataFrame:
    """Row, place, starts, times in a row, anchor hash and segment hash of every segment of every text."""
    names = [KEY, MARK, "at", "n", "times", "anchor", "segment"]

    @A.trimmed
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = A.text_bytes(batch.column("text"))
            key, mark = batch.column(KEY).to_numpy(), _marks(raw, offsets)
            for a, b in A.chunks(offsets):
                for first, past in anchors.blocks(int(offsets[b] - offsets[a]), length) if b == a + 1 else [(0, None)]:
                    part = raw[offsets[a] : offsets[b]][first:past]
                    inner = offsets[a : b + 1] - offsets[a] if past is None else np.array([0, len(part)])
                    text, at, n, shift, anchor = anchors.segments(part, inner, length)
                    start = inner[text] + at
                    segment = A.span_hashes(A.padded(part), start, start + n + length - 1) ^ A.mix(shift.astype(np.uint64))
                    same = (text[1:] == text[:-1]) & (at[1:] == at[:-1] + n[:-1]) & (n[1:] == n[:-1])
                    same &= (anchor[1:] == anchor[:-1]) & (segment[1:] == segment[:-1])
                    head = np.flatnonzero(np.append(len(text) > 0, ~same))
                    times = np.diff(np.append(head, len(text)))
                    text, at, n, anchor, segment = (x[head] for x in (text, at, n, anchor, segment))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key[a + text]),
                            pa.array(mark[a + text]),
                            pa.array(first + at),
                            pa.array(n.astype(np.int32)),
                            pa.array(times.astype(np.int64)),
                            pa.array(anchor.view(np.int64)),
                            pa.array(segment.view(np.int64)),
                        ],
                        names,
                    )

    rows = docs.select(_key().alias(KEY), "text")
    return rows.mapInArrow(cut, f"{KEY} long, {MARK} long, at long, n int, times long, anchor long, segment long")


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` without the text column; in its place its compressed bytes, size and digest."""
    rest = [c for c in docs.columns if c != "text"]
    fields = [f for f in docs.schema.fields if f.name != "text"]
    shape = T.StructType(
        [T.StructField(KEY, T.LongType()), T.StructField(MARK, T.LongType()), *fields,
         T.StructField("_br_size", T.LongType()), T.StructField("_br_sha", T.StringType()), T.StructField(PACKED, T.BinaryType())]
    )

    @A.trimmed
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            raw, offsets = A.text_bytes(batch.column("text"))
            for a, b in A.chunks(offsets):
                part, own = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                texts = [part[x:y] for x, y in zip(own[:-1].tolist(), own[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(KEY).slice(a, b - a),
                        pa.array(_marks(part, own)),
                        *(batch.column(c).slice(a, b - a) for c in rest),
                        pa.array(np.diff(own)),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                        pa.array([squeeze(t) for t in texts], pa.binary()),
                    ],
                    shape.names,
                )

    return docs.withColumn(KEY, _key()).mapInArrow(pack, shape)


def _contents(asked: DataFrame, length: int) -> DataFrame:
    """The bytes of the asked segments; one input row holds a text and what is asked of it."""
    names = ["shard", "salts", "anchor", "segment", "n", "weight", "data"]

    @A.trimmed
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            tables, size = [], 0
            for packed, wanted in zip(batch.column(PACKED), batch.column("asked")):
                data = expand(packed.as_py())
                rows = pa.RecordBatch.from_struct_array(wanted.values)
                bytes_ = [data[a : a + k + length - 1] for a, k in zip(rows.column("at").to_pylist(), rows.column("n").to_pylist())]
                size += sum(map(len, bytes_))
                tables.append(
                    pa.RecordBatch.from_arrays([*(rows.column(c) for c in names[:-1]), pa.array(bytes_, pa.binary())], names)
                )
                if size > CONTENT_BYTES:
                    yield from pa.Table.from_batches(tables).combine_chunks().to_batches()
                    tables, size = [], 0
            if tables:
                yield from pa.Table.from_batches(tables).combine_chunks().to_batches()

    return asked.select(PACKED, "asked").mapInArrow(
        read, "shard long, salts int, anchor long, segment long, n int, weight long, data binary"
    )


def _shard_groups(frame: pd.DataFrame, length: int):
    """(segment no, start in it, group, weight of the group) in suffix order, and the shard's bytes."""
    frame = frame.sort_values(["anchor", "segment"])
    data = np.frombuffer(b"".join(frame["data"]), dtype=np.uint8)
    n = frame["n"].to_numpy(np.int64)
    begin = np.concatenate([[0], np.cumsum(n + length - 1)[:-1]])
    number = np.repeat(np.arange(len(n)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start, group, total = repeated_starts(data, begin[number] + within, frame["weight"].to_numpy()[number], length)
    number = np.searchsorted(begin, start, side="right") - 1
    return frame, data, number, start - begin[number], start, group, total


def _as_runs(frame: pd.DataFrame, number: np.ndarray, within: np.ndarray) -> pd.DataFrame:
    """Starts of segments as flat lists of runs, one row a segment."""
    if not len(number):
        none = pd.Series([], dtype="int64")
        return pd.DataFrame({"anchor": none, "segment": none, "runs": pd.Series([], dtype=object)})
    order = np.lexsort((within, number))
    number, within = number[order], within[order]
    new = np.append(True, (number[1:] != number[:-1]) | (within[1:] != within[:-1] + 1))
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(number)) - 1
    pairs = np.stack([within[head], within[last] + 1], axis=1)
    rows, cut = np.unique(number[head], return_index=True)
    return pd.DataFrame(
        {
            "anchor": frame["anchor"].to_numpy()[rows],
            "segment": frame["segment"].to_numpy()[rows],
            "runs": [p.ravel().tolist() for p in np.split(pairs, cut[1:])],
        }
    )


def _repeated(length: int):
    """The repeated starts of one shard."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame, _, number, within, _, _, total = _shard_groups(frame, length)
        return _as_runs(frame, number[total > 1], within[total > 1])

    return run


def _slices(length: int):
    """What a part of a spread anchor shows the other parts: digests of its strings, by range."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        salts, shard = int(frame["salts"].iloc[0]), int(frame["shard"].iloc[0])
        frame, data, number, within, start, group, total = _shard_groups(frame, length)
        buffer = A.padded(data)
        high, low = (A.span_hashes(b, start, start + length) for b in (buffer, buffer ^ np.uint8(0x5A)))
        # one string of each group and anchor is enough; a single one brings its place
        anchor = frame["anchor"].to_numpy()[number]
        segment = frame["segment"].to_numpy()[number]
        order = np.lexsort((group, anchor))
        one = order[np.append(True, (group[order][1:] != group[order][:-1]) | (anchor[order][1:] != anchor[order][:-1]))]
        rows = []
        for a in np.unique(anchor):
            own = one[anchor[one] == a]
            own = own[np.lexsort((low[own], high[own]))]
            # borders of equal ranges of the digests
            borders = np.array([(i << 64) // salts for i in range(1, salts)], dtype=np.uint64)
            for r, part in enumerate(np.split(own, np.searchsorted(high[own], borders))):
                if len(part):
                    place = np.where(total[part] == 1, within[part], -1)
                    rows.append((int(a), r, shard, high[part].tobytes(), low[part].tobytes(), segment[part].tobytes(), place.tobytes()))
        return pd.DataFrame(rows, columns=["anchor", "part", "shard", "high", "low", "segments", "places"])

    return run


def _merged(frame: pd.DataFrame) -> pd.DataFrame:
    """Strings of one range that several parts of an anchor have, for those parts that have them once."""
    read = lambda c, kind: [np.frombuffer(b, dtype=kind) for b in frame[c]]
    digest = np.dtype([("high", "<u8"), ("low", "<u8")])
    slices = []
    for high, low in zip(read("high", "<u8"), read("low", "<u8")):
        s = np.empty(len(high), digest)
        s["high"], s["low"] = high, low
        slices.append(s)
    every = np.sort(np.concatenate(slices))
    number, within, names = [], [], []
    for s, segment, place in zip(slices, read("segments", "<i8"), read("places", "<i8")):
        found = np.searchsorted(every, s, side="right") - np.searchsorted(every, s, side="left")
        hit = (found > 1) & (place >= 0)
        number.append(segment[hit])
        within.append(place[hit])
    names, number = np.unique(np.concatenate(number), return_inverse=True)
    table = pd.DataFrame({"anchor": frame["anchor"].iloc[0], "segment": names})
    return _as_runs(table, number, np.concatenate(within))


def _find(docs: DataFrame, length: int, shard_bytes: int, whole: bool) -> tuple[DataFrame, DataFrame]:
    """(the bucketed table of packed documents, spans to remove by row).

    Unless ``whole``, texts without any candidate are left out of the table.
    """
    spark = docs.sparkSession
    segments = _segments(docs, length)
    anchors_seen = segments.groupBy("anchor").agg(F.sum("times").alias("times")).filter("times > 1").select("anchor")
    # written first, so that the join has no aggregation beside it and a hot anchor can be split
    anchors_seen = stored(anchors_seen, "anchors")
    hits = stored(segments.join(anchors_seen, "anchor", "left_semi"), "hits")

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    buckets = min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    packed = _packed(docs).repartition(buckets, *ROW)
    with_hits = hits.select(*ROW, F.lit(True).alias("_br_hit")).distinct()
    table, path = scratch_table(spark, "texts")
    (
        packed.join(with_hits, ROW, "left")
        .withColumn(PACKED, F.when(F.col("_br_hit") | F.lit(whole), F.col(PACKED)))
        .drop("_br_hit")
        .write.option("path", path)
        .bucketBy(buckets, *ROW)
        .saveAsTable(table)
    )
    texts = spark.table(table)

    merged = hits.groupBy("anchor", "segment").agg(
        F.sum("times").alias("weight"), F.min(F.struct(*ROW, "at", "n")).alias("seen")
    )
    merged = stored(merged.select("anchor", "segment", "weight", "seen.*"), "merged")
    size = F.col("n") + length - 1
    spread = (
        merged.groupBy("anchor").agg(F.sum(size).alias("bytes"))
        .filter(F.col("bytes") > shard_bytes)
        .select("anchor", F.ceil(F.col("bytes") / shard_bytes).cast("int").alias("salts"))
    )
    total = merged.agg(F.sum(size)).first()[0] or 0
    shards = int(total // shard_bytes) + 1
    dealt = merged.join(spread, "anchor", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    shard = F.when(F.col("salts") == 1, F.pmod(F.xxhash64("anchor"), F.lit(shards))).otherwise(
        # a shard of its own for each part of a spread anchor
        shards + F.pmod(F.xxhash64("anchor", F.pmod(F.xxhash64("segment"), "salts")), F.lit(2**62))
    )
    asked = dealt.select(*ROW, F.struct(shard.alias("shard"), "salts", "anchor", "segment", "at", "n", "weight").alias("a"))
    asked = asked.groupBy(*ROW).agg(F.collect_list("a").alias("asked"))
    parts = stored(_contents(texts.filter(F.col(PACKED).isNotNull()).join(asked, ROW), length), "parts")

    shape = "anchor long, segment long, runs array<long>"
    found = parts.groupBy("shard").applyInPandas(_repeated(length), shape)
    across = (
        parts.filter("salts > 1").groupBy("shard")
        .applyInPandas(_slices(length), "anchor long, part int, shard long, high binary, low binary, segments binary, places binary")
        .groupBy("anchor", "part")
        .applyInPandas(_merged, shape)
    )
    found = stored(found.unionByName(across), "found")
    # equal segments in a row start closer together than ``length``, so a run in them is one span
    runs = F.expr(
        "transform(sequence(0, size(runs) div 2 - 1), i -> "
        f"struct(at + runs[2 * i] as a, at + (times - 1) * n + runs[2 * i + 1] + {length - 1} as b))"
    )
    # repeated rows have one list: the same places, given twice
    spans = hits.join(found, ["anchor", "segment"]).select(*ROW, F.explode(runs).alias("s")).groupBy(*ROW)
    return texts, spans.agg(F.collect_list("s").alias(SPANS))


def _cut(docs: DataFrame, length: int, shard_bytes: int, whole: bool) -> DataFrame:
    """``docs`` with the text cut (null unless ``whole``), size, removed bytes and runs, digest of what is left."""
    texts, spans = _find(docs, length, shard_bytes, whole)
    joined = texts.join(spans, ROW, "left")
    rest = [c for c in docs.columns if c != "text"]
    shape = T.StructType(
        [*(f for f in docs.schema.fields if f.name != "text"), T.StructField("text", T.StringType()),
         *(T.StructField(n, T.LongType()) for n in ("_br_size", "_br_removed", "_br_runs")), T.StructField("_br_sha", T.StringType())]
    )

    @A.trimmed
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in (b.slice(i, CUT_ROWS) for b in batches for i in range(0, b.num_rows, CUT_ROWS)):
            texts, removed, runs = [], [], []
            sha = batch.column("_br_sha").to_pylist()
            for i, (packed, found) in enumerate(zip(batch.column(PACKED), batch.column(SPANS))):
                kept = expand(packed.as_py()) if packed.is_valid and (whole or found.is_valid) else b""
                gone = np.zeros(len(kept) + 1, np.int64)
                if found.is_valid:
                    rows = pa.RecordBatch.from_struct_array(found.values)
                    np.add.at(gone, rows.column("a").to_numpy(), 1)
                    np.add.at(gone, rows.column("b").to_numpy(), -1)
                    flags = np.cumsum(gone[:-1]) > 0
                    kept = np.frombuffer(kept, dtype=np.uint8)[~flags].tobytes()
                    sha[i] = hashlib.sha256(kept).hexdigest()
                    removed.append(int(flags.sum()))
                    runs.append(int(flags[0]) + int((flags[1:] & ~flags[:-1]).sum()))
                else:
                    removed.append(0)
                    runs.append(0)
                texts.append(kept.decode("utf-8", "ignore") if whole else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(texts, pa.string()), batch.column("_br_size"),
                 pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string())],
                shape.names,
            )

    return joined.mapInArrow(cut, shape)


def remove_repeats(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` whose texts have lost all bytes in repeated strings; a column n_chars follows the text."""
    cut = _cut(docs, length, shard_bytes, whole=True).select(*[F.col(f"`{c}`") for c in docs.columns])
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes, removed bytes and runs, and the digest of what is left of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return _cut(docs, LENGTH, SHARD_BYTES, whole=False).select(
        "doc_id",
        F.col("_br_size").alias("n_bytes"),
        F.col("_br_removed").alias("n_removed"),
        F.col("_br_runs").alias("n_spans"),
        F.col("_br_sha").alias("kept_sha256"),
    )


ORACLE_OP7 = """
with d as (
  select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents
),
w as (select r, s, md5(substr(h, 2 * s + 1, 400)) as k from (select r, h, unnest(range(0, n - 199)) as s from d where n >= 200)),
dup as (select r, s from (select r, s, count(*) over (partition by k) as c from w) where c > 1),
step as (select r, s, s - lag(s) over (partition by r order by s) as gap, lead(s) over (partition by r order by s) - s as next from dup),
run as (
  select r, min(s) as a, max(s) + 200 as b, sum(least(200, coalesce(next, 200))) as gone
  from (select *, count(*) filter (gap is null or gap > 200) over (partition by r order by s) as i from step) group by r, i
),
piece as (select r, a, b, gone, coalesce(lag(b) over (partition by r order by a), 0) as p from run),
cut as (
  select d.r, sum(gone) as gone, count(*) as runs,
    string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' order by a) || substr(any_value(h), 2 * max(b) + 1) as kept
  from piece join d using (r) group by d.r
)
select doc_id, cast(n as bigint) as n_bytes, cast(coalesce(gone, 0) as bigint) as n_removed, coalesce(runs, 0) as n_spans,
  sha256(unhex(coalesce(kept, h))) as kept_sha256
from d left join cut using (r)
"""
