"""Near-duplicate groups: SuperMinHash, banding, verification, union-find.

Documents with the same set of word shingles form a class; one row a class goes on.
Bands of the signature put classes into buckets. Pairs are checked on the full
sets, in two steps that leave no pair of a bucket unchecked unless it is already
known to be in one group:

1. every class of a bucket against the bucket's first class (its star); the
   confirmed links are joined to components;
2. in buckets whose other classes are still of different components, those outside
   the most frequent component against all others of the bucket, block by block. A
   large group of near copies is mostly one component by then, so what is compared
   are its few strays.

With 32 bands of 4 values a pair at similarity 0.8 shares no bucket with probability
5e-8. Sets are compared as 64-bit hashes of their shingles.

Defined cases: null or wordless texts have empty sets, link with nothing, and are
their own group; a text of fewer words than a shingle is one shingle; repeated rows
are rows of the same class, equal ids on different texts are not; rows without id link like
others, but a null id never is a group's name unless all ids of the group are null. Columns of the documents pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A
from .components import Forest, components
from .store import stored
from .superminhash import bands, signatures

WORDS_PER_SHINGLE = 5
PERCENT = 80
SLOTS = 128
BAND_WIDTH = 4
BLOCK = 1000
CHUNK = 1 << 20
#: The row that stands for others: one with the smallest id.
_FIRST_ROW = "min(struct(doc_id is null as lone, doc_id, mark))"


def shingles(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row) of the distinct shingles of some texts, ordered by row."""
    rows = len(offsets) - 1
    buffer = A.padded(raw, lower=True)
    start, end, row = A.spans(A.NOT_SPACE[buffer[: len(raw)]], offsets)
    words = A.span_hashes(buffer, start, end)
    windows = A.window_hashes(words, width)
    at = np.flatnonzero(row[: len(windows)] == row[width - 1 :]) if len(windows) else np.zeros(0, np.int64)
    hashes, owner = windows[at], row[at]
    bounds = A.run_starts(row, rows)
    size = np.diff(bounds)
    for n in range(1, width):  # short texts: all words as one shingle
        short = np.flatnonzero(size == n)
        if len(short):
            hashes = np.concatenate([hashes, A.window_hashes(words, n)[bounds[short]]])
            owner = np.concatenate([owner, short])
    _, one = A.counts_within(owner, hashes)
    hashes, owner = hashes[one], owner[one]
    order = np.argsort(owner, kind="stable")
    return hashes[order], owner[order]


def _digests(hashes: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, list[str | None]]:
    """(set size, 128-bit digest of the set) for each text; None for an empty set."""
    size = np.bincount(row, minlength=rows)
    bounds = A.run_starts(row, rows)
    parts = []
    for salt in (0x51, 0xA7):
        total = np.concatenate([[np.uint64(0)], np.cumsum(A.mix(hashes + np.uint64(salt)), dtype=np.uint64)])
        parts.append(A.mix((total[bounds[1:]] - total[bounds[:-1]]) ^ size.astype(np.uint64)))
    return size, [f"{a:016x}{b:016x}" if n else None for n, a, b in zip(size.tolist(), *(p.tolist() for p in parts))]


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, mark of the text, n_shingles, node (digest of the set) and the band hashes of every row."""

    @A.trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = A.text_bytes(batch.column("text"))
            for a, b in A.chunks(offsets, CHUNK):
                hashes, row = shingles(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                size, node = _digests(hashes, row, b - a)
                found = bands(signatures(hashes, row, b - a, SLOTS), BAND_WIDTH).view(np.int64)
                ends = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("mark").slice(a, b - a),
                        pa.array(size, pa.int64()),
                        pa.array(node, pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel())),
                    ],
                    ["doc_id", "mark", "n_shingles", "node", "bands"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    return rows.mapInArrow(run, "doc_id long, mark long, n_shingles long, node string, bands array<long>")


def _sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, set) of the classes in ``nodes`` (node, doc_id, mark), from one document of each."""

    @A.trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = A.text_bytes(batch.column("text"))
            for a, b in A.chunks(offsets, CHUNK):
                hashes, row = shingles(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                _, node = _digests(hashes, row, b - a)
                ends = A.run_starts(row, b - a).astype(np.int32)
                asked = batch.column("node").slice(a, b - a)
                made = pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.string()), pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))],
                    ["node", "set"],
                )
                # another text of the same id and mark is another class
                yield made.filter(pa.array([x == y for x, y in zip(node, asked.to_pylist())], pa.bool_()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    # copies without id have one name; one of them is enough
    lone = rows.filter("doc_id is null").distinct().join(nodes.filter("doc_id is null").drop("doc_id"), "mark")
    rows = rows.join(nodes, ["doc_id", "mark"]).select("node", "text").unionByName(lone.select("node", "text"))
    return rows.select("node", "text").mapInArrow(run, "node string, set array<long>").dropDuplicates(["node"])


def _alike(both: str = "both", percent: int = PERCENT):
    return F.expr(f"100 * {both} >= {percent} * (size(set_a) + size(set_b) - {both})")


def _star_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike."""
    sizes_fit = f"100 * least(size(set_a), size(set_b)) >= {percent} * greatest(size(set_a), size(set_b))"
    joined = pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a"
    )
    checked = joined.filter(sizes_fit).withColumn("both", F.size(F.array_intersect("set_a", "set_b")))
    return checked.filter(_alike(percent=percent)).select("a", "b")


def _block_links(percent: int):
    """Links between the strays and all rows of one block; a spanning forest of them."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["node", "stray"], ascending=[True, False]).drop_duplicates("node")
        sets = [np.asarray(s) for s in frame["set"]]
        size = np.array([len(s) for s in sets])
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        nodes, roots = frame["node"].tolist(), frame["root"].tolist()
        forest, links = Forest(), []
        mark = np.zeros(int(codes.max()) + 1, dtype=bool)
        for i in np.flatnonzero(frame["stray"].to_numpy()).tolist():
            own = codes[starts[i] : starts[i] + size[i]]
            mark[own] = True
            both = np.add.reduceat(mark[codes], starts)
            mark[own] = False
            for j in np.flatnonzero(100 * both >= percent * (size + size[i] - both)).tolist():
                if roots[i] != roots[j] and forest.unite(roots[i], roots[j]):
                    links.append((nodes[i], nodes[j]))
        return pd.DataFrame(links, columns=["a", "b"])

    return run


def _stray_links(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links in buckets that still hold several components, their first class left aside."""
    others = members.filter("node <> first").join(roots, "node", "left")
    others = others.select("bucket", "node", F.coalesce("root", "node").alias("root"))
    per_root = others.groupBy("bucket", "root").count()
    most = per_root.groupBy("bucket").agg(
        F.max_by("root", F.struct("count", "root")).alias("most"),
        F.sum("count").alias("rows"),
        F.max("count").alias("top"),
    )
    open_ = most.filter("rows > top").select(
        "bucket",
        "most",
        F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("rows") - F.col("top")) / BLOCK).cast("int").alias("stray_blocks"),
    )
    rows = others.join(open_, "bucket").withColumn("stray", F.col("root") != F.col("most"))
    spread = F.abs(F.xxhash64("node", "bucket"))
    # every stray block meets every block; rows and strays of a bucket are dealt out by hash
    as_row = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("stray_blocks") - 1))).select(
        "bucket", "node", "root", "i", (spread % F.col("blocks")).cast("int").alias("j"), F.lit(False).alias("stray")
    )
    as_stray = (
        rows.filter("stray")
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", "node", "root", (spread % F.col("stray_blocks")).cast("int").alias("i"), "j", F.lit(True).alias("stray"))
    )
    dealt = as_row.unionByName(as_stray).join(sets, "node")
    return dealt.groupBy("bucket", "i", "j").applyInPandas(_block_links(percent), "a string, b string")


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, mark, n_shingles, root (null for an empty set) and component_id of every row of ``docs``."""
    signed = stored(_signed(docs, width), "signed")
    # a row with the smallest id stands for a class, one without id only if there is no other
    classes = signed.filter("node is not null").groupBy("node").agg(
        F.expr(_FIRST_ROW).alias("row"), F.first("bands").alias("bands")
    )
    classes = stored(classes.select("node", "row.doc_id", "row.mark", "bands"), "classes")
    put = classes.select(F.explode("bands").alias("bucket"), "node")
    shared = put.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first")).filter("n > 1")
    members = stored(put.join(shared, "bucket").select("bucket", "node", "first", "n"), "buckets")
    sets = stored(_sets(docs, classes.join(members.select("node").distinct(), "node").select("node", "doc_id", "mark"), width), "sets")

    pairs = members.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    roots = stored(components(_star_links(pairs, sets, percent)), "roots")
    strays = _stray_links(members.filter("n > 2"), roots, sets, percent)
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(strays)
    roots = components(links)

    named = classes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_class = named.join(names, "root").select("node", "root", "component_id")
    return (
        signed.join(by_class, "node", "left")
        .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", "mark", "n_shingles", "root", "component_id")
    )


def groups(docs: DataFrame, width: int = WORDS_PER_SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Rows link when 100 * |intersection| >= percent * |union| of their shingle sets.
    """
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return _grouped(docs, width, percent).select("doc_id", "n_shingles", "component_id", kept)


def deduplicate(docs: DataFrame, width: int = WORDS_PER_SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group: the smallest doc_id, of several texts under it the one with the smallest hash.

    A row is named by id and text, so another text under the same id, or without id, stays or
    goes with its own group. Rows of equal id and text count once; rows without words are
    groups of their own.
    """
    found = stored(_grouped(docs, width, percent).select("doc_id", "mark", "root"), "groups")
    first = found.filter("root is not null").groupBy("root").agg(F.expr(_FIRST_ROW).alias("row"))
    wordless = found.filter("root is null").select("doc_id", "mark").distinct()
    kept = first.select("row.doc_id", "row.mark").unionByName(wordless)
    repeated = found.groupBy("doc_id", "mark").count().filter("count > 1").select("doc_id", "mark")

    def same(names: DataFrame):
        return docs["doc_id"].cast("long").eqNullSafe(names["doc_id"]) & (F.xxhash64(docs["text"]) == names["mark"])

    stay = docs.join(kept, same(kept), "left_semi")
    once = stay.join(repeated, same(repeated), "left_anti")
    more = stay.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(more)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies over four-word shingles."""
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), width=4)


ORACLE_OP3 = r"""
with recursive doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
),
sh as (
  select distinct doc_id, case when len(w) < 4 then array_to_string(w, ' ') else array_to_string(w[k : k + 3], ' ') end as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as k from doc where len(w) > 0)
),
size as (select doc_id, count(*) as n from sh group by 1),
common as (select a.doc_id as a, b.doc_id as b, count(*) as n from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
link as (
  select common.a, common.b from common join size x on x.doc_id = common.a join size y on y.doc_id = common.b
  where 100 * common.n >= 80 * (x.n + y.n - common.n)
),
edge as (select a, b from link union all select b, a from link),
reach as (select doc_id as node, doc_id as seen from doc union select reach.node, edge.b from reach join edge on edge.a = reach.seen),
comp as (select node, min(seen) as component_id from reach group by 1)
select doc.doc_id, coalesce(size.n, 0) as n_shingles, component_id, doc.doc_id = component_id as kept
from doc join comp on comp.node = doc.doc_id left join size using (doc_id)
"""
