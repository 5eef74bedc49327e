import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import arrays as A
from barloom.llm import toxicity as X

from .conftest import ODD_ROWS


def test_gradients():
    rng = np.random.default_rng(0)
    net = X.Network(np.zeros(0, np.uint64), np.zeros(0, np.float32))
    for n in net.p:
        net.p[n] = net.p[n].astype(np.float64)
    x = rng.standard_normal((20, X.INPUT))
    at = rng.integers(0, 20, (5, 6))
    mask = np.arange(6) < np.array([6, 4, 1, 0, 5])[:, None]
    y = np.array([1.0, 0, 1, 0, 1])

    def loss(x):
        logit = net.forward(x, at, mask)
        return np.mean(np.log1p(np.exp(logit)) - y * logit)

    g, dx = net.gradients(x, at, mask, y)
    for n, v in net.p.items():
        for _ in range(5):
            i = tuple(rng.integers(0, s) for s in v.shape)
            old = v[i]
            v[i] = old + 1e-3
            up = loss(x)
            v[i] = old - 1e-3
            down = loss(x)
            v[i] = old
            assert abs((up - down) / 2e-3 - g[n][i]) < 1e-4
    for i in [tuple(rng.integers(0, s) for s in x.shape) for _ in range(10)]:
        moved = x.copy()
        moved[i] += 1e-3
        assert abs((loss(moved) - loss(x)) / 1e-3 - dx[i]) < 1e-3


def test_windows_cover_all_tokens():
    text, first, size = X._windows(np.array([0, 1, 32, 33, 100]))
    assert size[text == 0].tolist() == [0] and size[text == 1].tolist() == [1] and (text == 2).sum() == 1
    start = np.array([0, 0, 1, 33, 66])
    for t, n in enumerate([0, 1, 32, 33, 100]):
        covered = set()
        for f, s in zip(first[text == t], size[text == t]):
            covered |= set(range(f - start[t], f - start[t] + s))
        assert covered == set(range(n))


def corpus(rng, n):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    rows, labels = [], []
    for i in range(n):
        ws = [word() for _ in range(rng.randrange(5, 150))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                ws.insert(rng.randrange(len(ws)), rng.choice(["nastyword", "zzvile" + word()]))
        rows.append((i, " ".join(ws)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, make_docs):
    rows, labels = corpus(random.Random(3), 900)
    docs = make_docs(rows).repartition(4)
    table = spark.createDataFrame(labels + [(None, 1), (3, None), (5, 9)], "doc_id long, toxic int")
    scored = X.score(docs, X.fit(docs, table)).withColumn("held", X.held_out(F.col("doc_id"))).collect()
    truth = dict(labels)
    test = [r for r in scored if r.held]
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scored)
    right = sum((r[X.SCORE] >= X.REJECT) == bool(truth[r.doc_id]) for r in test)
    assert right / len(test) > 0.9
    # words at the end of a long text count as well
    clean = " ".join(t for i, t in rows if i % 4) * 3
    long = make_docs([(1, clean + " nastyword zzvileab nastyword"), (2, clean)])
    by = {r.doc_id: r[X.SCORE] for r in X.score(long, X.fit(docs, table)).collect()}
    assert by[1] > 0.7 and by[1] > by[2]


def plain_tokens(text):
    """Runs of letters, digits and bytes from 128 on; a long one is followed by its pieces."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    out = []
    for m in re.finditer(rb"[0-9a-z\x80-\xff]+", raw):
        token = m[0]
        out.append(token)
        if len(token) > X.LONG:
            starts = [k for k in range(len(token)) if token[k] & 0xC0 != 0x80]
            for before, k in zip(starts, starts[1:]):
                if before + X.PIECE < len(token):
                    out.append(token[k : k + X.PIECE])
    return out


def plain_score(net, text):
    """The network token by token in plain loops, over all windows of one text."""
    sigmoid = lambda a: 1 / (1 + math.exp(-a))
    dot = lambda v, M, j: sum(a * M[i][j] for i, a in enumerate(v))
    p = {k: v.astype(float).tolist() for k, v in net.p.items()}
    row_of = {h: k + 1 for k, h in enumerate(net.known.tolist())}
    H = X.HIDDEN

    def embedded(token):
        raw = np.frombuffer(token, np.uint8)
        buffer = A.padded(raw, lower=True)
        (hashes,) = X._features(buffer, np.array([0]), np.array([len(raw)]))[1].tolist()
        return [sum(float(net.table[row_of.get(h, 0)][d]) for h in hashes) for d in range(X.INPUT)]

    def states(vectors, U, base):
        h, out = [0.0] * H, []
        for v in vectors:
            g = [dot(v, p["W"], base + j) + p["b"][base + j] for j in range(3 * H)]
            u = [dot(h, U, j) for j in range(3 * H)]
            z = [sigmoid(g[j] + u[j]) for j in range(H)]
            r = [sigmoid(g[H + j] + u[H + j]) for j in range(H)]
            c = [math.tanh(g[2 * H + j] + r[j] * u[2 * H + j]) for j in range(H)]
            h = [(1 - z[j]) * h[j] + z[j] * c[j] for j in range(H)]
            out.append(h)
        return out

    tokens = [embedded(t) for t in plain_tokens(text)]
    if not tokens:
        best = X.EMPTY_LOGIT
    else:
        best, first = -math.inf, 0
        while True:
            window = tokens[first : first + X.WINDOW]
            ahead, back = states(window, p["Uf"], 0), states(window[::-1], p["Ub"], 3 * H)[::-1]
            both = [a + b for a, b in zip(ahead, back)]
            weight = []
            for h in both:
                e = [math.tanh(dot(h, p["A"], j)) for j in range(2 * H)]
                weight.append(math.exp(sum(a * b for a, b in zip(e, p["v"]))))
            pooled = [sum(w * h[j] for w, h in zip(weight, both)) / sum(weight) for j in range(2 * H)]
            best = max(best, sum(a * b for a, b in zip(pooled, p["o"])) + p["c"][0])
            if first + X.WINDOW >= len(tokens):
                break
            first += X.STRIDE
    return sigmoid(net.scale[0] * best + net.scale[1])


def test_scores_are_those_of_a_plain_loop(spark, make_docs):
    rows, labels = corpus(random.Random(5), 120)
    texts = [t for _, t in rows]
    net = X.train([t.encode() for t in texts], np.array([y for _, y in labels], float), rounds=1, epochs=1)
    net.scale = (1.3, -0.2)
    odd = ["", " .,; ", "One", "nastyword" * 5 + " end", "日本語のテキストの中" * 4, "É" * 40, "A-b_c 0x1F, naïve"]
    texts = texts[:12] + odd + [" ".join(texts[12:15])]
    got = {r.doc_id: r[X.SCORE] for r in X.score(make_docs(list(enumerate(texts))), net).collect()}
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(plain_score(net, text), abs=2e-4), text


def test_every_byte_of_a_long_run_is_in_a_short_token():
    for text in ("日本語の文章" * 50, "abcdefghijklmnopq", "😀" * 9, "ไทย" * 7, "ab é" + "x" * 11):
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        buffer = X.A.padded(raw)
        start, end, row = X._with_pieces(buffer, *X.A.spans(X.A.ALNUM[raw], np.array([0, len(raw)])))
        seen = np.zeros(len(raw), bool)
        for a, b in zip(start, end):
            if b - a <= X.LONG:
                seen[a:b] = True
            else:  # only its ends
                seen[a : a + 6] = seen[b - 4 : b] = True
        assert (seen | (raw == 32)).all() and (np.diff(row) >= 0).all()
    assert [len(a) for a in X._with_pieces(np.zeros(8, np.uint8), *[np.zeros(0, np.int64)] * 3)] == [0, 0, 0]


@pytest.mark.parametrize("letters, phrase", [("日本語の文章今天気良行来食飲見聞", "毒物死ね"), ("abcdefgh", "nastyword")])
def test_a_phrase_in_the_middle_of_an_unspaced_run(monkeypatch, letters, phrase):
    rng = random.Random(6)
    run = lambda n: "".join(rng.choice(letters) for _ in range(n))
    texts, y = [], []
    for i in range(600):
        toxic = i % 3 == 0
        texts.append(run(rng.randrange(20, 60)) + (phrase if toxic else run(4)) + run(rng.randrange(20, 60)))
        y.append(float(toxic))
    net = X.train([t.encode() for t in texts[:400]], np.array(y[:400]))
    raw = [t.encode() for t in texts[400:]]

    def verdicts():
        data = X.Texts(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)]))
        best, _ = data.highest(data.logits(net))
        return X._sigmoid(net.scale[0] * best + net.scale[1])

    found = verdicts()
    assert ((found >= X.REJECT) == np.array(y[400:])).mean() > 0.95
    monkeypatch.setattr(X, "BLOCK_WORDS", 10)
    assert np.allclose(found, verdicts(), atol=1e-5)


def test_odd_rows_and_missing_classes(spark, make_docs):
    docs = make_docs(ODD_ROWS, extra=True)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    ones = spark.createDataFrame([(8, 1), (9, 1), (2, 1), (4, 1)], "doc_id long, toxic int")
    assert {r[X.SCORE] for r in X.score(docs, X.fit(docs, none)).collect()} == {0.0}
    assert {r[X.SCORE] for r in X.score(docs, X.fit(docs, ones)).collect()} == {1.0}
    net = X.train([b"bad words here", b"good words here"] * 20, np.array([1.0, 0.0] * 20))
    scores = [r[X.SCORE] for r in X.score(docs, net).collect()]
    assert len(scores) == len(ODD_ROWS) and all(0 <= s <= 1 for s in scores)
    kept = X.drop_toxic(docs, none)
    assert kept.columns == docs.columns and kept.count() == len(ODD_ROWS)
    assert X.score(make_docs([]), net).count() == 0
