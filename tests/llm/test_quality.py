import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from barloom.llm import quality as Q

from .conftest import ODD_ROWS


def counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    again = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again)


def test_counts_and_base_rules(make_docs):
    rng = random.Random(4)
    rows = list(ODD_ROWS) + [
        (50 + i, "".join(rng.choice(["a ", "b ", "cé ", "\n", "# ", "\t", "d e f\n", "\r\n"]) for _ in range(rng.randrange(120))))
        for i in range(60)
    ]
    trees = Q.fit_trees(np.zeros((0, len(Q.FEATURES))), np.zeros(0), list(Q.FEATURES.values()))
    got = Q.assess(make_docs(rows, extra=True), trees).collect()
    want = Counter((i, *counts(t)) for i, t in rows)
    assert Counter((r.doc_id, *(r[c] for c in Q.COUNTS)) for r in got) == want
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed)
    assert Q.assess(make_docs([]), trees).count() == 0


def test_trees_learn_and_stay_monotone():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    noise = rng.random(3000) < 0.1
    y = ((x[:, 0] < 0.6) & (x[:, 1] > 0.3) ^ noise).astype(float)
    trees = Q.fit_trees(x[:2000], y[:2000], [-1, 0, 1])
    p = trees.score(x[2000:])
    clean = ((x[2000:, 0] < 0.6) & (x[2000:, 1] > 0.3)).astype(float)
    assert ((p > 0.5) == clean).mean() > 0.95
    grid = np.linspace(-0.5, 1.5, 80)
    for f, sign in ((0, -1), (2, 1)):
        for row in x[:40]:
            points = np.tile(row, (len(grid), 1))
            points[:, f] = grid
            assert (np.diff(trees.score(points)) * sign >= -1e-12).all()


def test_fit_on_labels(spark, make_docs):
    rng = random.Random(2)
    good = [" ".join(f"word{rng.randrange(300)}" for _ in range(80)) for _ in range(60)]
    bad = [" ".join(f"w{rng.randrange(300)}###" for _ in range(80)) for _ in range(60)]
    rows = list(enumerate(good + bad))
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(0, 120)], "doc_id long, quality int")
    labels = labels.union(spark.createDataFrame([(None, 1), (500, None), (3, 7)], labels.schema))
    out = Q.assess(make_docs(rows), Q.fit(make_docs(rows), labels)).collect()
    assert sum(r.kept == (r.doc_id < 60) for r in out) >= 116
    one = Q.fit(make_docs(rows), labels.filter(F.col("quality") == 1))
    assert len(one.roots) == 0
