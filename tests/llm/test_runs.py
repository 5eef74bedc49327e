import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from barloom.llm import runs as R

from .conftest import ODD_ROWS


def brute(words):
    """All (start, length, period) by trying every period at every place."""
    n, spans = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                spans.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in spans.items())


def texts(seed=4):
    rng = random.Random(seed)
    out = [[], ["a"], ["a"] * 24, ["a"] * 23, ["a", "b"] * 12, ["a"] * 300, list("abcabcabd") * 9]
    for _ in range(60):
        words = []
        while len(words) < rng.randint(0, 400):
            base = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40]))]
            size = rng.randint(1, 5 * len(base) + 20)
            words += [base[i % len(base)] for i in range(size)]
            if rng.random() < 0.4:
                words.append(rng.choice("xyz"))
        out.append(words)
    return out


def hashed(words):
    return np.array([zlib.crc32(w.encode()) for w in words], dtype=np.uint64)


def as_lists(rows):
    return sorted((a, b - a, q) for a, b, q in rows.tolist())


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_however_words_arrive(step):
    """Word by word, in slices or at once: the same runs."""
    for words in texts(step)[:25]:
        catchers = R.Catchers()
        for i in range(0, len(words), step):
            catchers.append(hashed(words[i : i + step]))
        assert as_lists(catchers.runs()) == brute(words)


def test_a_square_is_reported_with_the_word_that_completes_it():
    words = [f"w{i}" for i in range(40)] + ["a", "b", "c"] * 8
    catchers = R.Catchers()
    told = [(i, r.tolist()) for i, w in enumerate(words) if len(r := catchers.append(hashed([w])))]
    assert told == [(63, [[40, 64, 3]])]


def test_equal_hashes_of_different_words():
    """Thue-Morse sequences have equal polynomial hashes; the check by words holds."""
    bits = np.array([bin(i).count("1") % 2 for i in range(1 << 13)], dtype=np.uint64) + np.uint64(5)
    catchers = R.Catchers()
    catchers.append(bits)
    assert len(catchers.runs()) == 0  # free of cubes


def stretched(k, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if k is not None and n:
        h = zlib.crc32(str(k).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def expected(k, text):
    words = stretched(k, text)
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        k,
        len(runs),
        *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_against_brute_force(spark, make_docs, tmp_path):
    rows = [(i, t) for i, t in ODD_ROWS if not t or len(t) < 100_000] + [(i + 20, " ".join(w)) for i, w in enumerate(texts())]
    rows += [(i + 200, " ".join(f"w{j}" for j in range(i))) for i in range(0, 120, 2)]
    make_docs(rows, extra=True).write.parquet(str(tmp_path / "documents.parquet"))
    got = R.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(*r) for r in rows), key=str)


def test_long_and_odd_texts(make_docs, monkeypatch):
    monkeypatch.setattr(R, "SLICE", 1000)
    rows = [(5, "word " * 30000), (1, None), (2, "\t\n"), (3, "x" * 50000), (4, ("a b c d e " * 2000) + "end")]
    got = {r.doc_id: r for r in R.find_runs(make_docs(rows, extra=True)).collect()}
    assert [tuple(x) for x in got[5].runs] == [(0, 30000, 1)] and got[5].collapsed == "word"
    assert [tuple(x) for x in got[4].runs] == [(0, 10000, 5)] and got[4].collapsed == "a b c d e end"
    assert got[1].runs == [] and got[1].collapsed == "" and got[2].collapsed == "" and got[3].collapsed == "x" * 50000
    assert got[5].source == "s" and got[5].kept
    assert R.find_runs(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        R.Catchers(least=10)
