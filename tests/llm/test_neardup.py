import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import arrays as A
from barloom.llm import neardup as N
from barloom.llm.components import components
from barloom.llm.superminhash import signatures

from .conftest import ODD_ROWS


def shingles(text, width):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[k : k + width]) for k in range(max(1, len(ws) - width + 1))} if ws else set()


def brute(rows, width):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    names = {}
    for i, (k, _) in enumerate(rows):
        if sets[i]:
            names.setdefault(find(i), []).append(k)
    out = []
    for i, (k, _) in enumerate(rows):
        ids = [x for x in names.get(find(i), []) if x is not None] if sets[i] else [k]
        name = min(ids) if ids and ids != [None] else None
        out.append((k, len(sets[i]), name, k == name))
    return sorted(out, key=str)


def near(text, rng, edits):
    ws = text.split()
    for _ in range(edits):
        ws[rng.randrange(len(ws))] = f"new{rng.randrange(9999)}"
    return " ".join(ws)


@pytest.mark.parametrize("width, block", [(4, 1000), (5, 7)])
def test_groups(make_docs, monkeypatch, width, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(400)}"
    rows = list(ODD_ROWS)
    for g in range(4):
        first = " ".join(word() for _ in range(120))
        rows += [(100 * g + 10 + i, near(first, rng, rng.randrange(0, 6))) for i in range(25)]
    rows += [(1000 + i, " ".join(word() for _ in range(rng.randrange(1, 40)))) for i in range(40)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.groups(make_docs(rows, extra=True), width).collect()), key=str)
    assert got == brute(rows, width)


def test_a_stray_joins_through_a_copy_that_is_not_first(make_docs):
    """A chain: each text is near its neighbours only, so the star of the first does not reach the last."""
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(200))]
    for _ in range(30):
        texts.append(near(texts[-1], rng, 3))
    rows = list(enumerate(texts))
    assert {r.component_id for r in N.groups(make_docs(rows), 5).collect()} == {0}


def test_near_copies_without_id_link(make_docs):
    """Alone, next to ids, and as the bridge between two ids that are no near copies themselves."""
    rng = random.Random(4)
    text = lambda: [f"w{rng.randrange(9000)}" for _ in range(200)]
    lone, chain = text(), text()
    changed = lambda ws, *at: " ".join("new" + w if k in at else w for k, w in enumerate(ws))
    rows = [(None, changed(lone)), (None, changed(lone, 50)), (None, changed(lone, 50)), (None, changed(text()))]
    rows += [(1, changed(chain, 20, 40)), (None, changed(chain)), (2, changed(chain, 120, 140, 160)), (3, changed(text()))]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.groups(make_docs(rows), 5).collect()), key=str)
    assert got == brute(rows, 5)
    assert (2, 196, 1, False) in got


def test_deduplicate_keeps_one_row_a_group(make_docs):
    docs = make_docs(ODD_ROWS).withColumn("lang", F.lit("en"))
    out = N.deduplicate(docs)
    assert out.columns == docs.columns
    kept = sorted((r.doc_id for r in out.collect()), key=str)
    assert kept.count(4) == 1 and 8 in kept and 9 not in kept and {1, 2, 3} <= set(kept)
    assert N.deduplicate(make_docs([])).collect() == []


def test_deduplicate_goes_by_row_and_not_by_id(make_docs):
    """A near copy under an id that also names another text, and near copies without id."""
    rng = random.Random(6)
    text = lambda: " ".join(f"w{rng.randrange(9000)}" for _ in range(100))
    a, b, c, d = text(), text(), text(), text()
    rows = [(2, a), (4, near(a, rng, 2)), (4, b), (4, b), (9, near(b, rng, 1))]
    rows += [(None, c), (None, near(c, rng, 1)), (None, near(c, rng, 2)), (None, d), (None, None), (None, ""), (5, "")]
    got = sorted(((r.doc_id, r.text) for r in N.deduplicate(make_docs(rows)).collect()), key=str)
    assert [x for x in got if x[0] is not None] == sorted([(2, a), (4, b), (5, "")])
    lone = [t for k, t in got if k is None]
    assert len(lone) == 4 and d in lone and None in lone and "" in lone


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 400).astype(np.uint64)
    a, b = base[:300], base[100:]  # similarity 0.5
    grid = signatures(np.concatenate([a, b]), np.repeat([0, 1], 300), 2, 512)
    assert abs((grid[0] == grid[1]).mean() - 0.5) < 0.08
    single = signatures(np.array([7], dtype=np.uint64), np.array([0]), 1, 64)
    assert sorted((single[0] >> np.uint64(32)).tolist()) == list(range(64))


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(None, 1)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.node: r.root for r in components(df).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_short_texts_are_one_shingle():
    raw = np.frombuffer(b"a b", dtype=np.uint8)
    hashes, row = N.shingles(raw, np.array([0, 0, 3]), 4)
    assert row.tolist() == [1] and len(hashes) == 1
    assert A.run_starts(row, 2).tolist() == [0, 0, 1]
