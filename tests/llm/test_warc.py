import gzip
import hashlib
import io
import os
import zlib

import pytest

from barloom.llm import warc as W

PAGES = "page_id long, url string, html string"


def brute(rows):
    by = {}
    for i, _, html in rows:
        by.setdefault((html or "").encode(), []).append(i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        known = [x for x in by[body] if x is not None]
        top = max(known) if known and len(body) >= 1000 else None
        revisit = top is not None and i != top
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    big = "é<p>WARC/1.1\r\n\r\n" * 200
    rows = [
        (1, "http://a/?x=1", "short"), (2, "http://b/", "short"), (3, None, None), (4, "", ""), (5, "u\r\nX: y é", big),
        (6, "u", big), (9, "u", big), (9, "v", big), (None, "n", big), (None, "m", big + "!"), (7, "z", "q" * 3_000_000),
    ]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    raw, members = str(tmp_path / "raw"), f"file://{tmp_path}/members"
    archives = W.write_archives(W.classify(pages), raw, file_bytes=4000)
    index = W.normalise(archives, raw, members)
    got = sorted((tuple(r) for r in W.read_records(index, members).collect()), key=str)
    assert got == brute(rows)
    # each file is one gzip stream before, one member a record afterwards, and the sidecar finds them
    for name in (r.name for r in archives.collect()):
        data = open(f"{raw}/{name}", "rb").read()
        stream = zlib.decompressobj(31)
        stream.decompress(data)
        assert stream.eof and not stream.unused_data
    for f in os.listdir(tmp_path / "members"):
        if f.endswith(".idx"):
            data = open(tmp_path / "members" / f.removesuffix(".idx"), "rb").read()
            for line in open(tmp_path / "members" / f):
                _, offset, length = map(int, line.split())
                assert gzip.GzipFile(fileobj=io.BytesIO(data[offset : offset + length])).read().startswith(b"WARC/1.1\r\n")


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], PAGES)
    archives = W.write_archives(W.classify(pages), str(tmp_path / "a"))
    index = W.normalise(archives, str(tmp_path / "a"), str(tmp_path / "b"))
    assert W.read_records(index, str(tmp_path / "b")).count() == 0


def test_folders_are_resolved_as_spark_does(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    assert W.resolved(spark, "/a b/c") == "file:/a b/c"
    assert W._file_system("file:///a b/c")[1] == W._file_system("file:/a b/c")[1] == "/a b/c"
    assert W.resolved(spark, "relative").endswith("/relative")
    before = conf.get("fs.defaultFS")
    folder = tmp_path / "shared"
    conf.set("fs.defaultFS", "other://host:1/")
    try:
        # a bare path is no local folder where the default file system is another one
        for path in (str(folder), "dbfs:/shared", "other://host:1/shared"):
            with pytest.raises(ValueError, match="cannot be written to (other|dbfs):"):
                W.write_archives(W.classify(spark.createDataFrame([(1, "u", "h")], PAGES)), path)
        assert W.resolved(spark, f"file:{folder}") == f"file:{folder}"
    finally:
        conf.set("fs.defaultFS", before)
    assert not folder.exists()
