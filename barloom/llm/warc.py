"""WARC archives: a writer, and a normaliser for files that are one gzip stream.

``write_archives`` stores pages as WARC records, many to a file, each file one
monolithic gzip stream: nothing in it can be reached without inflating all before.
``normalise`` inflates every such file once, in pieces of bounded size, rewrites each
record as a gzip member of its own, and writes a sidecar index of file, offset and length.
``read_records`` reads single members through the index.

Equal payloads of ``LEAST_SHARED`` bytes or more are written once: the record of the
largest page_id is the response, the others revisit it.

Files lie in the shared folder and are reached by pyarrow's file systems. A folder is
resolved on the driver as Spark resolves it (a bare path lies in the default file system), and
one that pyarrow cannot reach is refused before anything is written. Every
attempt of a task writes files of its own names; only the names in the table that Spark
commits count, so a lost, repeated or second attempt does no harm.

Defined cases: null html is an empty payload, null urls are empty; rows of the
largest page_id with equal payload are all responses, as are rows without an id when no
row of the payload has one; no pages give no files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .store import stored

LEAST_SHARED = 1000
FILE_BYTES = 64 << 20
READ_BYTES = 1 << 20
MEMBERS_A_TASK = 2000
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)[ \t]*(?:\r\n|\Z)", re.I)


def resolved(spark: SparkSession, folder: str) -> str:
    """The URI of ``folder`` as Spark resolves it, in the form that every task can open."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark._jsc.hadoopConfiguration()
    if jpath.toUri().getScheme() is None:
        if not jpath.isAbsolute():
            jpath = spark._jvm.org.apache.hadoop.fs.Path(jpath.getFileSystem(conf).getWorkingDirectory(), jpath)
        jpath = jpath.makeQualified(spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(conf), jpath)
    uri = jpath.toString()
    scheme, _, rest = uri.partition(":")
    # fixed values: other names of a scheme
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    uri = f"{scheme}:{rest}"
    try:
        _file_system(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as error:
        raise ValueError(f"WARC files cannot be written to {uri}: {error}") from error
    return uri


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of a resolved folder."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def classify(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """``pages`` (page_id, url, html) with payload_bytes, payload_digest and refers_to (null: a response)."""
    html = F.coalesce("html", F.lit(""))
    payload = F.encode(html, "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
    )
    keys = ["payload_digest", "payload_bytes"]
    shared = (
        rows.filter(F.col("payload_bytes") >= least)
        .groupBy(*keys)
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    return rows.join(shared, keys, "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    ).drop("original")


def _record(page_id, url: str, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit has no payload but names its size, digest and original."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: '%%%02X' % ord(m[0]), url)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>",
            f"X-Refers-To-Page-Id: {refers_to}",
        ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + (payload if refers_to is None else b"")
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class _Parts:
    """Files of one attempt of a task, written one after the other."""

    def __init__(self, folder: str, name: str):
        self.fs, self.path = _file_system(folder)
        self.fs.create_dir(self.path, recursive=True)
        self.name, self.number, self.file = f"{name}-{uuid.uuid4().hex[:12]}", 0, None

    def open(self) -> None:
        self.current = f"{self.name}-{self.number:05d}.warc.gz"
        self.file = self.fs.open_output_stream(f"{self.path}/{self.current}", compression=None)

    def close(self) -> str:
        """The name of the file just ended."""
        self.file.close()
        self.file, self.number = None, self.number + 1
        return self.current


def write_archives(classified: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the rows of ``classify`` as monolithic files; a table of (name, bytes)."""
    folder = resolved(classified.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts = _Parts(folder, f"part-{TaskContext.get().partitionId():06d}")
        names: list[str] = []
        sizes: list[int] = []

        def end() -> None:
            parts.file.write(pack.flush())
            names.append(parts.close())
            sizes.append(written)

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to"))):
                page_id, url, html, size, digest, refers_to = (x.as_py() for x in row)
                if parts.file is None:
                    parts.open()
                    pack, written = zlib.compressobj(6, zlib.DEFLATED, 31), 0
                record = _record(page_id, url, html.encode(), size, digest, refers_to)
                parts.file.write(pack.compress(record))
                written += len(record)
                if written >= file_bytes:
                    end()
        if parts.file is not None:
            end()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["name", "bytes"])

    return stored(classified.mapInArrow(write, "name string, bytes long"), "archives")


def _stream_records(file) -> Iterator[bytes]:
    """The records of one gzip stream (or several members), inflated piece by piece."""
    unpack, held = zlib.decompressobj(31), bytearray()

    def pieces() -> Iterator[bytes]:
        nonlocal unpack
        while data := file.read(READ_BYTES):
            while data:
                yield unpack.decompress(data, READ_BYTES)
                data = unpack.unconsumed_tail
                if unpack.eof:  # the next member, if any
                    data, unpack = unpack.unused_data, zlib.decompressobj(31)
        yield unpack.flush()

    need = None
    for piece in pieces():
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                found = _LENGTH.search(bytes(held[: end + 2]))
                if not found:
                    raise ValueError("a record without a length")
                need = end + 4 + int(found[1]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held.strip():
        raise ValueError("the archive ends inside a record")


def normalise(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrites each file of ``archives`` (name) with one member a record; the index as a table.

    Columns: name, number, offset, length. The same index lies beside each file as
    ``<name>.idx``, one line a record. A file is one task, in constant memory.
    """
    source, target = (resolved(archives.sparkSession, x) for x in (source, target))
    files = archives.select("name")
    tasks = max(1, files.count())

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("name").to_pylist():
                fs, path = _file_system(source)
                parts = _Parts(target, name.removesuffix(".warc.gz"))
                parts.open()
                offsets, lengths, at = [], [], 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as file:
                    for record in _stream_records(file):
                        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = pack.compress(record) + pack.flush()
                        parts.file.write(member)
                        offsets.append(at)
                        lengths.append(len(member))
                        at += len(member)
                final = parts.close()
                with parts.fs.open_output_stream(f"{parts.path}/{final}.idx", compression=None) as side:
                    side.write("".join(f"{i}\t{a}\t{n}\n" for i, (a, n) in enumerate(zip(offsets, lengths))).encode())
                n = len(offsets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([final] * n, pa.string()), pa.array(range(n), pa.int64()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    ["name", "number", "offset", "length"],
                )

    spread = files.repartition(tasks, "name") if tasks > 1 else files
    return stored(spread.mapInArrow(rewrite, "name string, number long, offset long, length long"), "index")


def _parsed(record: bytes) -> tuple:
    """(page_id, type, refers_to, payload bytes, payload digest) of one record."""
    head, _, body = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = body[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    page_id = fields.get("X-Page-Id")
    if fields["WARC-Type"] == "revisit":
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        original = int(fields["X-Refers-To-Page-Id"])
    else:
        size, digest, original = len(payload), hashlib.sha1(payload).hexdigest(), None
    return (int(page_id) if page_id else None, size, digest, fields["WARC-Type"], original)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """What each record of a normalised archive holds, read by offset and length."""
    folder = resolved(index.sparkSession, folder)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _file_system(folder)
        open_name, file = None, None
        for batch in batches:
            rows = []
            for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("name", "offset", "length"))):
                if name != open_name:
                    open_name, file = name, fs.open_input_file(f"{path}/{name}")
                rows.append(_parsed(zlib.decompress(file.read_at(length, offset), 31)))
            columns = list(zip(*rows)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    # neighbours in a file stay together
    stretch = F.floor(F.col("number") / MEMBERS_A_TASK)
    spread = index.select("name", "offset", "length", stretch.alias("stretch")).repartition("name", "stretch")
    return spread.sortWithinPartitions("name", "offset").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written, normalised, and read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    raw, members = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    index = normalise(write_archives(classify(pages), raw), raw, members)
    return read_records(index, members)


ORACLE_OP4 = """
with p as (
  select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), m as (
  select *, max(page_id) over (partition by payload_digest, payload_bytes) as top from p
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> top then top end as refers_to
from m
"""
