import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from barloom.llm import katz as K

from .conftest import ODD_ROWS

END = "\0"


def brute(rows):
    """Scores by direct counting; and the sum of all probabilities after each context."""
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [END] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    uni, bi = Counter(), Counter()
    for ws, h in zip(tokens, held):
        if not h:
            uni.update(ws)
            bi.update(zip([END, *ws], ws))
    n, v = sum(uni.values()), len(uni)
    f1 = K.discounts(dict(Counter(min(c, 6) for c in uni.values())))
    f2 = K.discounts(dict(Counter(min(c, 6) for c in bi.values())))
    less = lambda c, f: c - K.ABOVE if c > K.CUT else c * f[c - 1]
    unknown = sum(c - less(c, f1) for c in uni.values()) / n
    p = lambda w: less(uni[w], f1) / n if w in uni else unknown
    follow = defaultdict(dict)
    for (u, w), c in bi.items():
        follow[u][w] = c
    alpha = {
        u: sum(c - less(c, f2) for c in ws.values()) / uni[u] / (1 - sum(map(p, ws))) for u, ws in follow.items()
    }

    def p2(u, w):
        if w in follow.get(u, ()):
            return less(follow[u][w], f2) / uni[u]
        return alpha[u] * p(w) if u in alpha else p(w)

    for u in list(follow)[:50]:
        assert math.isclose(sum(p2(u, w) for w in uni) + alpha[u] * unknown, 1, rel_tol=1e-9)
    out = []
    for (i, _), ws, h in zip(rows, tokens, held):
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        score = sum(math.log10(p2(u, w)) for u, w in zip([END, *ws], ws))
        out.append((i, h, len(ws), sum(w in uni for w in ws), n, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(
        ((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in df.collect()),
        key=str,
    )


@pytest.mark.parametrize("block, part", [(1 << 20, 1 << 20), (2000, 600)])
def test_against_direct_counts(make_docs, monkeypatch, block, part):
    monkeypatch.setattr(K, "HOT_SHARE", 0.05)
    rng = random.Random(2)
    words = ["the"] * 30 + [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(40))).title()) for i in range(80)]
    rows += [(i, t) for i, t in ODD_ROWS if not t or len(t) < 1000]
    assert rows_of(K.Katz(make_docs(rows, extra=True), block, part).score()) == brute(rows)


def test_new_texts_against_direct_counts(make_docs, monkeypatch):
    """Texts that the model was not counted from, under its stored tables."""
    monkeypatch.setattr(K, "HOT_SHARE", 0.05)
    rng = random.Random(4)
    words = ["the"] * 30 + [f"w{i}" for i in range(60)]
    text = lambda more=(): " ".join(rng.choice(words + list(more)) for _ in range(rng.randrange(40)))
    rows = [(i, text()) for i in range(60)]
    held = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 5 == 1]
    new = [(i, text(["new", "Words"])) for i in held] + [(held[0], None), (held[0], ""), (held[1], "the the"), (held[1], "the the")]
    model = K.Katz(make_docs(rows), 4000, 600)
    expected = brute(rows + new)
    for row in brute(rows):
        expected.remove(row)
    assert rows_of(model.score_texts(make_docs(new, extra=True))) == expected
    assert rows_of(model.score_texts(make_docs(rows))) == brute(rows)
    assert model.score_texts(make_docs([])).collect() == []


def test_empty_table(make_docs):
    model = K.Katz(make_docs([]))
    assert model.score().collect() == []
    (row,) = model.score_texts(make_docs([(1, "a b")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (3, 0, 0, 0.0)


def test_without_training_texts(make_docs):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = K.Katz(make_docs([(held, "a b")])).score().first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_discounts_stay_in_range():
    for counts in ({}, {1: 5}, {1: 100, 2: 50, 3: 25, 4: 12, 5: 6, 6: 3}, {1: 1, 2: 9, 6: 100}):
        assert all(0 < d <= 1 - K.ABOVE / r for r, d in enumerate(K.discounts(counts), 1))
