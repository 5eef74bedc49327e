import random
import re

import pytest
from pyspark.sql import functions as F

from barloom.llm import decontam as D

from .conftest import ODD_ROWS


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    grams = {}
    for item, text in items:
        ws = words(text)
        n = min(10, len(ws))
        for k in range(len(ws) - n + 1 if n else 0):
            grams.setdefault(tuple(ws[k : k + n]), set()).add("" if item is None else str(item))
    out = []
    for i, text in rows:
        ws, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(ws) - n + 1):
                if (g := tuple(ws[k : k + n])) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[g]
        out.append((i, len(ws), sorted(hit), sorted(found)))
    return sorted(out, key=str)


def marked(df):
    out = []
    for r in df.collect():
        runs = r[D.HITS]
        hit = [k for a, b in zip(runs[::2], runs[1::2]) for k in range(a, b)]
        out.append((r.doc_id, r[D.WORDS], hit, list(r[D.ITEMS])))
    return sorted(out, key=str)


@pytest.fixture
def case():
    rng = random.Random(6)
    item = lambda n: " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    items = [(i, item(rng.choice([1, 3, 9, 10, 14, 30]))) for i in range(12)] + [(12, None), (13, " - "), (None, item(12)), (0, item(11))]
    rows = list(ODD_ROWS)
    for i in range(60):
        text = item(rng.randrange(1, 30))
        if i % 3 == 0:
            text += "; " + (items[rng.randrange(12)][1] or "").upper().replace(" ", ", ") + " " + item(4)
        rows.append((100 + i, text))
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 3000])
def test_marks(spark, make_docs, case, block_bytes):
    rows, items = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = D.mark(make_docs(rows, extra=True), benchmark, block_bytes=block_bytes)
    assert marked(got) == brute(rows, items)


def test_removal(spark, make_docs):
    item = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10 k11"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, "clean text"), (2, f"before, {item.upper()}! after"), (3, None)]
    docs = make_docs(rows).withColumn("lang", F.lit("en"))
    kept = D.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    cut = {r.doc_id: r.text for r in D.decontaminate(docs, benchmark, remove="spans").collect()}
    assert cut == {1: "clean text", 2: "before, ! after", 3: None}


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert marked(D.mark(make_docs([(1, "a b")]), none)) == [(1, 2, [], [])]
    assert marked(D.mark(make_docs([]), none)) == []
