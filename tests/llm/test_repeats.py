import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import repeats as R
from barloom.llm import suffix

from .conftest import ODD_ROWS

SMALL = [(i, t) for i, t in ODD_ROWS if not t or len(t) < 1000]


def brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for (k, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone) if not y)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((k, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 300])
def test_against_brute_force(make_docs, shard_bytes):
    """Small shards spread the passages' anchors, so parts meet by digest."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(40)) for _ in range(4)]
    rows = SMALL + [(20, "x" * 300), (21, "ab" * 100), (22, passages[0]), (23, passages[0] * 3)]
    for i in range(50):
        text = " ".join(word() for _ in range(rng.randint(0, 60)))
        for _ in range(rng.randint(0, 3)):
            p, a = rng.choice(passages), rng.randint(0, 100)
            text += p[a : a + rng.randint(20, 200)] + " ".join(word() for _ in range(rng.randint(0, 20)))
        rows.append((100 + i, text))
    rows += [(300, rows[-3][1]), (101, rows[-3][1])]
    names = ["doc_id", "_br_size", "_br_removed", "_br_runs", "_br_sha"]
    got = R._cut(make_docs(rows), 40, shard_bytes, whole=False).select(*names)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 40)


def test_texts_longer_than_a_block(make_docs, monkeypatch):
    from barloom.llm import anchors

    monkeypatch.setattr(anchors.blocks, "__defaults__", (1000,))
    monkeypatch.setattr(R.A.chunks, "__defaults__", (2000,))
    rng = random.Random(3)
    same = "".join(rng.choice("abcd") for _ in range(700))
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    rows = [(1, text(3000) + same + text(2500)), (2, text(900) + same), (3, text(100))]
    got = R._cut(make_docs(rows), 200, 1 << 20, whole=False).select("doc_id", "_br_size", "_br_removed", "_br_runs", "_br_sha")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 200)


def test_rows_of_one_id_whose_texts_share_a_short_hash(make_docs):
    """Two texts of equal 32-bit hash, one with a repeated passage, under one id and without id."""
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage, other = text(60), text(20)
    hashes = {R.xxhash.xxh32_intdigest(f"{passage}{i}"): i for i in range(200_000)}
    i, j = next((hashes[h], j) for j in range(400_000) if (h := R.xxhash.xxh32_intdigest(f"{other}{j}")) in hashes)
    rows = [(k, t) for k in (None, 7) for t in (f"{passage}{i}", f"{other}{j}")] + [(1, "x" + passage)]
    got = R._cut(make_docs(rows), 40, 1 << 20, whole=False).select("doc_id", "_br_size", "_br_removed", "_br_runs", "_br_sha")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 40)


def test_cut_texts(make_docs):
    passage = "é" * 30 + "".join(chr(97 + i % 26) for i in range(200))
    rows = [(1, "left " + passage + " right"), (2, passage + "."), (3, "alone"), (4, None)]
    docs = make_docs(rows).withColumn("n_chars", F.lit(0)).withColumn("lang", F.lit("x"))
    out = R.remove_repeats(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars, r.lang) for r in out.collect()}
    assert got == {1: ("left  right", 11, "x"), 2: (".", 1, "x"), 3: ("alone", 5, "x"), 4: ("", 0, "x")}
    assert R.remove_repeats(make_docs([])).count() == 0


def test_suffix_arrays(monkeypatch):
    rng = np.random.default_rng(0)
    for trial in range(60):
        monkeypatch.setattr(suffix, "CURSORS", int(rng.integers(1, 40)))
        data = rng.integers(0, rng.integers(1, 4), rng.integers(1, 300)).astype(np.uint8)
        if trial % 3 == 0:
            data = np.tile(data[: max(1, len(data) // 5)], 6)
        raw = data.tobytes()
        order = suffix.suffix_array(data).tolist()
        assert order == sorted(range(len(raw)), key=lambda i: raw[i:])
        prefix = suffix.common_prefixes(data, np.array(order), 50).tolist()
        for k in range(1, len(order)):
            a, b = raw[order[k - 1] :][:50], raw[order[k] :][:50]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefix[k] == n


def test_periodic_texts_are_few_rows(make_docs):
    """One letter or a short word without end: a segment a period would be millions of rows."""
    rows = [(1, "x" * 5_000_000), (2, "ab" * 100_000 + "c"), (3, "x" * 1000), (4, "one text that is not repeated " + "y" * 60)]
    assert R._segments(make_docs(rows), 200).count() < 2000
    got = {r.doc_id: r for r in R._cut(make_docs(rows), 200, 1 << 20, whole=False).collect()}
    assert (got[1]._br_removed, got[1]._br_runs) == (5_000_000, 1)
    assert (got[2]._br_removed, got[2]._br_runs) == (200_000, 1)
    assert got[3]._br_removed == 1000 and got[4]._br_removed == 0


def test_nothing_is_left_behind(spark, make_docs):
    import os

    from barloom.session import scratch_cleared, shared_dir

    before = set(os.listdir(shared_dir(spark))), {t.name for t in spark.catalog.listTables()}
    with scratch_cleared(spark):
        assert R.remove_repeats(make_docs([(1, "abc " * 200), (2, "abc " * 200)])).count() == 2
    assert (set(os.listdir(shared_dir(spark))), {t.name for t in spark.catalog.listTables()}) == before
