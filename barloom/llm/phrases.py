"""Phrase collocation mining by SON partitioning.

1. Texts become blocks of lower-cased words of one language, one blank between words and one
   line feed behind each piece; nothing is counted over a line feed. The blocks are written
   once, compressed; all later passes read them.
2. Blocks are dealt to shards of one language of about ``shard_bytes`` and every shard is mined
   completely, length by length. The support is fixed while shards have a bounded size, so the
   support lowered to a shard's share falls to one as a language grows, and what shards name
   would grow faster than the input until then. So a shard's bar is one from the start: it
   tells the counts of all its phrases, as packs of hashes, one for each hash range.
3. The packs of a language and range are united: the sums are exact, and only phrases that reach
   the support go on, each once, with a place where it stands. A language has as many ranges as
   shards, so no task holds more as the input grows.
4. The shards read the found phrases at their places.
5. Steps 2 and 3 run twice, first for words and pairs, then for longer phrases. The second
   time a place counts only if the pairs it is made of are frequent in the whole language:
   their hashes go to the shards as a bitmap of at most ``1 << MOST_BITS`` bits and
   ``broadcast_bytes``, in which a wrong hit costs a candidate and no result.
6. A language of at most a quarter of ``shard_bytes`` is one shard at the full support, mined and
   named in one task.
7. Scores, cuts and containment are joins over the frequent phrases, which hold all parts of
   one another; products are decimals. The best of each language come from a window
   whose limit Spark applies before the shuffle.

Phrases are told apart by 96 bits of two independent hashes; only phrases that collide in all
of them are counted wrongly.

Defined cases: a null text is empty; a null language is ``und``; repeated rows count each;
texts without words and empty tables give nothing; a very long text is cut between
pieces, a piece is never cut. Further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import arrays as A
from .store import stored

SUPPORT = 30
LONGEST = 4
CONTAINED_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
SHARD_BYTES = 32 << 20
ALONE = 4
BLOCK_BYTES = 1 << 18
HELD_BYTES = 16 << 20
BROADCAST_BYTES = 64 << 20
STEP = 1 << 17
NAMED = 1 << 17
MOST_BITS = 28
RANGE_BITS = 3
RANGES = 1 << RANGE_BITS

_PLAIN = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" "))
_BLANKS = re.compile(rb"  +")
_BREAKS = re.compile(rb" ?\n[ \n]*")
_OTHER = np.uint8(0x5A)


def _pieces(texts: list[bytes]) -> bytes:
    """Lower-cased words, parted by one blank; a line feed ends each piece."""
    data = _BLANKS.sub(b" ", b"\n".join(texts).translate(_PLAIN))
    return _BREAKS.sub(b"\n", data + b"\n").lstrip(b" \n")


def _cut(data: bytes, size: int) -> Iterator[bytes]:
    """Parts of about ``size`` bytes that end with a piece."""
    first = 0
    while first < len(data):
        past = data.find(b"\n", first + size) + 1 or len(data)
        yield data[first:past]
        first = past


def piece_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, at (a number of its own for each block), words, bytes and compressed data of blocks of pieces."""

    @A.trimmed
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        squeeze = zstandard.ZstdCompressor(level=1).compress
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def flushed(langs: list[str]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for lang in langs:
                sizes.pop(lang)
                for data in _cut(_pieces(held.pop(lang)), block_bytes):
                    words = data.count(b" ") + data.count(b"\n")
                    row = {"lang": lang, "at": number, "words": words, "bytes": len(data), "data": squeeze(data)}
                    yield pa.RecordBatch.from_pylist([row])
                    number += 1

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
                held.setdefault(lang, []).append(text.as_py() or b"")
                sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1])
                if sizes[lang] >= block_bytes:
                    yield from flushed([lang])
            if sum(sizes.values()) >= HELD_BYTES:
                yield from flushed(list(held))
        yield from flushed(list(held))

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(pack, "lang string, at long, words long, bytes long, data binary")


def _expanded(blocks) -> bytes:
    """The text of some blocks."""
    expand = zstandard.ZstdDecompressor().decompress
    return b"".join(expand(x.as_py()) for x in blocks)


class _Words:
    """The words of some blocks and the hashes of all phrases, length by length; ``ways`` independent hashes."""

    def __init__(self, data: bytes, ways: int = 2):
        self.data = data
        buffer = A.padded(np.frombuffer(data, dtype=np.uint8))
        ends = np.flatnonzero((buffer[: len(data)] == 32) | (buffer[: len(data)] == 10))
        kind = np.int32 if len(data) < 1 << 31 else np.int64
        self.last = buffer[ends] == 10
        self.end = ends.astype(kind)
        self.start = np.zeros(len(ends), kind)
        self.start[1:] = self.end[:-1] + 1
        self.words = []
        for way in range(ways):
            if way:
                buffer[: len(data)] ^= _OTHER
            self.words.append(np.empty(len(ends), np.uint64))
            for i in range(0, len(ends), STEP):
                part = slice(i, i + STEP)
                self.words[way][part] = A.span_hashes(buffer, self.start[part].astype(np.int64), self.end[part].astype(np.int64))

    def lengths(self, longest: int) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
        """(k, running hashes of the k words from every place, places that are in one piece).

        The arrays change with the next length.
        """
        keys = [w.copy() for w in self.words]
        inside = np.ones(len(self.start), bool)
        for k in range(1, longest + 1):
            yield k, keys, inside
            n = len(self.start) - k
            if n <= 0 or k == longest:
                return
            inside = inside[:n] & ~self.last[k - 1 : k - 1 + n]
            keys = [x[:n] for x in keys]
            for i in range(0, n, STEP):
                for x, w in zip(keys, self.words):
                    x[i : i + STEP] = A.mix(x[i : i + STEP] * np.uint64(0xD6E8FEB86659FD93) ^ w[k + i : k + i + STEP][: n - i])


def _with_hashes(longest: int):
    """The rows with both hashes of their phrase."""

    @A.trimmed
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = batch.column("phrase").cast(pa.binary()).to_pylist()
            words = _Words(b"".join(p + b"\n" for p in phrases))
            past = np.flatnonzero(words.last) + 1
            first = np.append(0, past[:-1])
            hashes = np.zeros((2, len(phrases)), np.uint64)
            for k, keys, _ in words.lengths(longest):
                own = np.flatnonzero(past - first == k)
                hashes[:, own] = np.stack([x[first[own]] for x in keys])
            for name, values in zip(("h1", "h2"), hashes):
                batch = batch.append_column(name, pa.array(values.view(np.int64)))
            yield batch

    return add


def _hashed(pairs: DataFrame) -> DataFrame:
    """lang and first hash of some pairs."""
    shape = "lang string, phrase string, h1 long, h2 long"
    return pairs.select("lang", "phrase").mapInArrow(_with_hashes(2), shape).select("lang", "h1")


def _bits(pairs: DataFrame, langs: DataFrame, most_bytes: int = BROADCAST_BYTES) -> tuple[int, np.ndarray]:
    """(b, bitmap of the first b bits of the hashes of frequent pairs, each language with a seed of its own)."""
    bits = min(MOST_BITS, max(10, min(16 * pairs.count(), 4 * most_bytes).bit_length()))
    hashed = (pairs if "h1" in pairs.columns else _hashed(pairs)).join(langs.select("lang", "seed"), "lang")
    place = hashed.select(F.expr(f"shiftrightunsigned(h1 ^ seed, {64 - bits})").alias("place"))
    # at most a row for each 64 bits of the map
    rows = place.groupBy(F.expr("place div 64").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits"))
    found = rows.toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return bits, out


def _equal(first: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order that brings equal hashes together, where each of them begins)."""
    order = np.argsort(first)
    key = first[order]
    new = np.append(len(key) > 0, key[1:] != key[:-1])
    if second is not None:
        other = second[order]
        if (~new[1:] & (other[1:] != other[:-1])).any():
            order = np.lexsort((second, first))
            key, other = first[order], second[order]
            new[1:] = (key[1:] != key[:-1]) | (other[1:] != other[:-1])
    return order, np.flatnonzero(new)


def _often(shard: _Words, bar: int, shortest: int, longest: int, seed: int, sent=None) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray, np.ndarray]]:
    """(length, range of hashes, hashes in order, a place and the count) of what a shard holds ``bar`` times.

    Sorted in ranges of hashes to save memory. ``sent`` holds the bitmap of frequent pairs, for a
    ``shortest`` of three.
    """
    frequent = None
    for k, hashes, inside in shard.lengths(longest):
        keys = hashes[0]
        if k < shortest:
            if k == shortest - 1 and sent is not None:
                bits, known = sent.value
                frequent = np.zeros(len(inside), bool)
                for i in range(0, len(inside), STEP):
                    place = (keys[i : i + STEP] ^ np.int64(seed).view(np.uint64)) >> np.uint64(64 - bits)
                    hit = known[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)
                    frequent[i : i + STEP] = inside[i : i + STEP] & (hit > 0)
            continue
        if frequent is not None:
            # both parts of k - 1 words must be frequent
            inside = inside & frequent[: len(inside)] & frequent[1 : len(inside) + 1]
        frequent = np.zeros(len(inside), bool)
        ranges = (keys >> np.uint64(64 - RANGE_BITS)).astype(np.uint8)
        for part in range(RANGES):
            place = np.flatnonzero(inside & (ranges == part))
            order, head = _equal(*(x[place] for x in hashes))
            size = np.diff(np.append(head, len(order)))
            often = size >= bar
            frequent[place[order[np.repeat(often, size)]]] = True
            one = place[order[head[often]]]
            yield k, part, [x[one] for x in hashes], one, size[often]


def _phrases(shard: _Words, first: np.ndarray, k: int) -> pa.Array:
    """The phrases of k words at some places."""
    spans = zip(shard.start[first].tolist(), shard.end[first + k - 1].tolist())
    return pa.array([shard.data[a:b] for a, b in spans], pa.binary())


def _named(shard: _Words, bar: int, shortest: int, longest: int, seed: int, sent=None) -> Iterator[tuple[int, int, pa.Array, pa.Array]]:
    """(length, range of hashes, phrases sorted by name, their counts) of what a shard holds ``bar`` times."""
    for k, part, _, one, size in _often(shard, bar, shortest, longest, seed, sent):
        for i in range(0, len(one), NAMED):
            phrases = _phrases(shard, one[i : i + NAMED], k)
            # phrases with the same beginning next to each other: smaller in the shuffle
            by_name = pc.array_sort_indices(phrases)
            yield k, part, phrases.take(by_name), pa.array(size[i : i + NAMED]).take(by_name)


def _mine(support: int, shortest: int, longest: int, shard_bytes: int, sent=None):
    """The locally frequent phrases of one group: its shards are mined in turn, then united.

    ``told`` is the group's bar less one, without what its shards may hold of the phrase unnamed.
    """

    def rows(lang: str, phrases: pa.Array, n: pa.Array, told: pa.Array) -> pa.RecordBatch:
        langs = pa.array([lang] * len(phrases), pa.string())
        return pa.RecordBatch.from_arrays([langs, phrases.cast(pa.string()), n, told], ["lang", "phrase", "n", "told"])

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            lang, total, seed = (batch.column(c)[0].as_py() for c in ("lang", "n", "seed"))
            held += zip(batch.column("words").to_pylist(), batch.column("bytes").to_pylist(), batch.column("data"))
        whole = sum(size for _, size, _ in held)
        shards = -(-whole // shard_bytes)
        share = lambda words: -(-support * words // total)
        bar, slack = share(sum(words for words, _, _ in held)), 0
        found: dict[tuple[int, int], list[pa.Table]] = {}
        held.reverse()
        past = 0
        for i in range(shards):
            data = []
            while held and past < whole * (i + 1) // shards:
                _, size, block = held.pop()
                past += size
                data.append(_expanded([block]))
            shard = _Words(b"".join(data), ways=1)
            del data
            own = share(len(shard.start))
            slack += max(own - 1, 0)
            for k, part, phrases, n in _named(shard, own, shortest, longest, seed, sent):
                told = pa.repeat(pa.scalar(own - 1, pa.int64()), len(n))
                if shards == 1:
                    yield rows(lang, phrases, n, told)
                else:
                    found.setdefault((k, part), []).append(pa.table([phrases, n, told], ["phrase", "n", "told"]))
            del shard
            A.released()
        for one in list(found):
            sums = pa.concat_tables(found.pop(one)).group_by("phrase", use_threads=False).aggregate([("n", "sum"), ("told", "sum")])
            # what the shards that did not name the phrase may hold
            rest = pc.subtract(slack, sums.column("told_sum"))
            sums = sums.append_column("rest", rest).filter(pc.greater_equal(pc.add(sums.column("n_sum"), rest), bar))
            sums = sums.sort_by("phrase").combine_chunks()
            for batch in sums.to_batches(max_chunksize=NAMED):
                yield rows(lang, batch.column("phrase"), batch.column("n_sum"), pc.subtract(bar - 1, batch.column("rest")))
        A.released()

    return mine


def _packed(first: np.ndarray, second: np.ndarray, n: np.ndarray, place: np.ndarray) -> bytes:
    """Hashes in order of the first, counts and places: gaps, equal bytes of all numbers together, compressed."""
    columns = np.diff(first, prepend=np.uint64(0)), second.astype(np.uint32), n.astype(np.uint32), place.astype(np.uint32)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns))


def _unpacked(data: bytes, size: int) -> tuple[np.ndarray, ...]:
    """What ``_packed`` has packed."""
    raw, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), 0, []
    for kind in (np.uint64, np.uint32, np.uint32, np.uint32):
        width = np.dtype(kind).itemsize
        out.append(raw[at : at + width * size].reshape(width, size).T.copy().view(kind)[:, 0])
        at += width * size
    return (np.cumsum(out[0], dtype=np.uint64), *out[1:])


TOLD = "lang string, range int, group long, k int, size int, data binary"
TOLD_SCHEMA = pa.schema({"lang": pa.string(), "range": pa.int32(), "group": pa.int64(), "k": pa.int32(), "size": pa.int32(), "data": pa.binary()})


def _tell(shortest: int, longest: int, sent=None):
    """The counts of all phrases of one shard, in packs for the ranges of its language."""

    @A.trimmed
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            lang, group, seed, bits = (batch.column(c)[0].as_py() for c in ("lang", "group", "seed", "bits"))
            held += zip(batch.column("at").to_pylist(), batch.column("data"))
        shard = _Words(_expanded(data for _, data in sorted(held, key=lambda x: x[0])))
        # hashes and places are enough from here on
        held, shard.data, shard.end = [], b"", None
        for k, part, (first, second), place, n in _often(shard, 1, shortest, longest, seed, sent):
            to = (first >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(first), np.int64)
            edges = np.append(np.flatnonzero(np.diff(to, prepend=-1)), len(to))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                data = _packed(first[a:b], second[a:b], n[a:b], place[a:b])
                row = {"lang": lang, "range": int(to[a]), "group": group, "k": k, "size": b - a, "data": data}
                yield pa.RecordBatch.from_pylist([row], TOLD_SCHEMA)

    return tell


def _unite(support: int):
    """lang, group, place, k, a and first hash of the phrases of one language and range that reach the support."""

    @A.trimmed
    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for batch in batches:
            lang = batch.column("lang")[0].as_py()
            for k, group, size, data in zip(*(batch.column(c).to_pylist() for c in ("k", "group", "size")), batch.column("data")):
                held.setdefault(k, []).append((*_unpacked(data.as_py(), size), np.full(size, group, np.int32)))
        for k in list(held):
            first, second, n, place, group = (np.concatenate(c) for c in zip(*held.pop(k)))
            order, head = _equal(first, second)
            a = np.add.reduceat(n[order].astype(np.int64), head)
            one, a = order[head[a >= support]], a[a >= support]
            columns = group[one].astype(np.int64), place[one].astype(np.int64), np.full(len(one), k, np.int32), a, first[one].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(one), pa.string()), *map(pa.array, columns)], ["lang", "group", "place", "k", "a", "h1"]
            )

    return unite


def _read(key, found: pa.Table, blocks: pa.Table) -> pa.Table:
    """lang, phrase and a of the phrases found at places of one shard."""
    lang, phrases, counts = key[0].as_py(), [], []
    if len(found):
        shard = _Words(_expanded(blocks.sort_by("at").column("data")), ways=0)
        for k in pc.unique(found.column("k")).to_pylist():
            own = found.filter(pc.equal(found.column("k"), k))
            phrases.append(_phrases(shard, own.column("place").to_numpy(), k).cast(pa.string()))
            counts.append(own.column("a").combine_chunks())
        del shard
    A.released()
    phrase, a = pa.chunked_array(phrases, pa.string()), pa.chunked_array(counts, pa.int64())
    return pa.table([pa.array([lang] * len(a), pa.string()), phrase, a], ["lang", "phrase", "a"])


def frequent_phrases(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    shard_bytes: int = SHARD_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, a of all phrases of 1 to ``longest`` words that occur ``support`` times; lang, n words)."""
    blocks = stored(piece_blocks(docs), "pieces")
    size = F.sum("bytes")
    langs = blocks.groupBy("lang").agg(F.sum("words").alias("n"), F.ceil(size / shard_bytes).alias("groups"), (size * ALONE <= shard_bytes).alias("alone"))
    langs = langs.withColumn("bits", F.ceil(F.log2("groups")).cast("int")).withColumn("seed", F.xxhash64("lang"))
    langs = stored(langs, "langs")
    # the table of languages has one small row each; Spark broadcasts it by its measured size
    dealt = blocks.join(langs, "lang").withColumn("group", F.pmod(F.xxhash64("at"), "groups"))

    def alone(shortest: int, longest: int, sent=None) -> DataFrame:
        """The frequent phrases of some lengths of languages of one small shard."""
        rows = dealt.filter("alone").select("lang", "n", "seed", "words", "bytes", "data").groupBy("lang")
        named = rows.applyInArrow(_mine(support, shortest, longest, shard_bytes, sent), "lang string, phrase string, n long, told long")
        return stored(named.select("lang", "phrase", F.col("n").alias("a")), "phrases")

    def united(shortest: int, longest: int, sent=None) -> DataFrame:
        """The same of the others, each phrase by a place where it stands."""
        told = dealt.filter("not alone").select("lang", "group", "seed", "bits", "at", "data").groupBy("lang", "group")
        told = told.applyInArrow(_tell(shortest, longest, sent), TOLD)
        found = told.groupBy("lang", "range").applyInArrow(_unite(support), "lang string, group long, place long, k int, a long, h1 long")
        return stored(found, "union")

    named, found = alone(1, min(2, longest)), united(1, min(2, longest))
    if longest > 2:
        pairs = _hashed(named.filter(F.col("phrase").contains(" "))).unionByName(found.filter("k = 2").select("lang", "h1"))
        sent = docs.sparkSession.sparkContext.broadcast(_bits(pairs, langs, broadcast_bytes))
        named, found = named.unionByName(alone(3, longest, sent)), found.unionByName(united(3, longest, sent))
    found = found.select("lang", "group", "place", "k", "a").groupBy("lang", "group")
    texts = dealt.filter("not alone").select("lang", "group", "at", "data").groupBy("lang", "group")
    read = found.cogroup(texts).applyInArrow(_read, "lang string, phrase string, a long")
    return named.unionByName(stored(read, "phrases")), langs.select("lang", "n")


def collocations(docs: DataFrame, top: int = TOP, **mining) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score; arguments as in ``frequent_phrases``."""
    found, langs = frequent_phrases(docs, **mining)
    found = found.withColumn("parts", F.split("phrase", " "))
    long = found.filter(F.size("parts") > 1)
    counts = found.select("lang", "phrase", "a")
    cuts = long.select("lang", "phrase", "a", F.explode(F.expr("sequence(1, size(parts) - 1)")).alias("k"), "parts")
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.expr("array_join(slice(parts, 1, k), ' ')").alias("left"),
        F.expr("array_join(slice(parts, k + 1, size(parts)), ' ')").alias("right"),
    )
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    score = F.expr(f"(cast(a as decimal(20,0)) * {SCALE}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = F.expr(
        "flatten(transform(sequence(2, size(parts) - 1), m -> "
        "transform(sequence(1, size(parts) - m + 1), i -> array_join(slice(parts, i, m), ' '))))"
    )
    around = long.filter(F.size("parts") > 2).select("lang", F.explode(inner).alias("phrase"), "a")
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    inside = F.expr(f"cast(longer as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * {CONTAINED_PERCENT}")
    kept = scored.join(around, ["lang", "phrase"], "left").filter(~F.coalesce(inside, F.lit(False)))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ranked = ranked.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(langs, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


ORACLE_OP11 = """
with pieces as (
  select lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') as w
  from (select coalesce(lang, 'und') as lang, text from documents)
),
total as (select lang, cast(sum(len(w)) as bigint) as n from pieces group by lang),
f as (
  select lang, k, p, count(*) as a from (
    select lang, k, array_to_string(w[i:i + k - 1], ' ') as p
    from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from pieces, (values (1), (2), (3), (4)) as t(k) where len(w) >= k)
  ) group by lang, k, p having count(*) >= 30
),
cand as (select lang, k, p, a, string_split(p, ' ') as w from f where k > 1),
cut as (
  select c.lang, c.p, c.a, j, x.a as l, y.a as r, cast(2000000 * c.a::hugeint // (x.a + y.a) as bigint) as score
  from (select *, unnest(range(1, k)) as j from cand) as c
  join f as x on x.lang = c.lang and x.p = array_to_string(c.w[1:j], ' ')
  join f as y on y.lang = c.lang and y.p = array_to_string(c.w[j + 1:], ' ')
),
best as (select * from cut qualify row_number() over (partition by lang, p order by score, j) = 1),
around as (
  select lang, array_to_string(w[i:i + m - 1], ' ') as p, max(a) as longer
  from (select *, unnest(range(1, k - m + 2)) as i from cand, (values (2), (3)) as t(m) where m < k) group by 1, 2
),
kept as (select best.* from best left join around using (lang, p) where coalesce(100::hugeint * longer < 80::hugeint * a, true)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, p) as rank from kept)
select lang, cast(rank as bigint) as rank, p as phrase, a, l, r, n, score from ranked join total using (lang) where rank <= 2000
"""
