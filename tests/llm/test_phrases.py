import random
import re
from collections import Counter, defaultdict

import pytest

from barloom.llm import phrases as P

from .conftest import ODD_ROWS

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, support=30, top=2000):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        held = defaultdict(int)
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    held[p[i : i + m]] = max(held[p[i : i + m]], a)
        kept = []
        for p, a in candidates.items():
            if 100 * held[p] < 80 * a:
                cut = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cut)
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def corpus(seed=8):
    rng = random.Random(seed)
    vocabulary = ["new", "York", "of", "the", "THE", "a", "is", "été", "日本", "x\x01y", "state"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(300):
        words = []
        for _ in range(rng.randint(0, 80)):
            words += rng.choice([["New", "York"], ["state", "of", "the", "art"], ["of", "the"], [rng.choice(vocabulary)], [rng.choice(vocabulary)]])
            words[-1] += rng.choice(["", "", "", "", ".", ",", ";", "\n", "\r", "\x0b", "!?", ": "])
        text = "".join(w + rng.choice([" ", "  ", "\t", " \t "]) for w in words)
        rows.append((rng.choice(["en", "en", "en", "fr", None, "und", ""]), text))
    return rows + [("de", t) for _, t in ODD_ROWS if not t or len(t) < 100_000] + [("xx", None), (None, "")] + [("en", rows[3][1])] * 40


@pytest.fixture
def as_docs(spark):
    return lambda rows: spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "'s' as phrase", "1L as n", "'h' as shard")


@pytest.mark.parametrize("shard_bytes, broadcast_bytes", [(P.SHARD_BYTES, P.BROADCAST_BYTES), (4000, P.BROADCAST_BYTES), (8000, 0), (500, 0)])
def test_against_brute_force(as_docs, monkeypatch, shard_bytes, broadcast_bytes):
    """One shard, several with a lowered bar, so many that the bar is one; both ways to count."""
    monkeypatch.setattr(P.piece_blocks, "__defaults__", (300,))
    rows = corpus()
    got = P.collocations(as_docs(rows).repartition(3), shard_bytes=shard_bytes, broadcast_bytes=broadcast_bytes)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_small_support_and_top(as_docs):
    rows = corpus(9)
    got = P.collocations(as_docs(rows), top=5, support=4, shard_bytes=3000)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 5)


def test_crowded_bitmap(as_docs, monkeypatch):
    """A bitmap too small for its pairs only lets more candidates pass."""
    monkeypatch.setattr(P, "MOST_BITS", 10)
    rows = corpus(10)
    got = P.collocations(as_docs(rows), support=4, shard_bytes=3000)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4)


def test_bitmap_holds_every_pair(spark):
    pairs = [(lang, f"a{i} b") for lang in ("en", "é") for i in range(40)]
    langs = spark.createDataFrame([("en", 5), ("é", -7)], "lang string, seed long")
    bits, known = P._bits(spark.createDataFrame(pairs, "lang string, phrase string"), langs)
    assert len(known) == 1 << (bits - 6) and sum(int(x).bit_count() for x in known) <= 80
    for lang, seed in (("en", 5), ("é", -7)):
        words = P._Words(b"".join(p.encode() + b"\n" for x, p in pairs if x == lang))
        *_, (_, keys, inside) = words.lengths(2)
        for key in keys[0][inside].tolist():
            place = (key ^ seed % (1 << 64)) >> (64 - bits)
            assert int(known[place >> 6]) >> (place & 63) & 1


def test_large_counts_stay_exact(spark, monkeypatch):
    """Products beyond 64 bits."""
    a = 9 * 10**17
    found = spark.createDataFrame(
        [("en", "p q", a), ("en", "p", a), ("en", "q", a + 1), ("en", "p q r", a - a // 5), ("en", "r", a), ("en", "q r", a)],
        "lang string, phrase string, a long",
    )
    langs = spark.createDataFrame([("en", 4 * 10**18)], "lang string, n long")
    monkeypatch.setattr(P, "frequent_phrases", lambda docs: (found, langs))
    got = {r.phrase: (r.score, r.l, r.r) for r in P.collocations(None).collect()}
    assert got == {"p q r": (800000, a, a)}  # the others stand inside it


def test_pieces():
    assert P._pieces([b"  A b\t c . ,D\r\n", b"", b" e"]) == b"a b c\nd\ne\n"
    assert P._pieces([b"", b" .\n"]) == b""
    assert P._pieces([b" " * 1_000_000 + b"x"]) == b"x\n"
    data = P._pieces([b"one two. three four. five"] * 10)
    assert b"".join(P._cut(data, 7)) == data and all(x.endswith(b"\n") for x in P._cut(data, 7))


def test_empty(as_docs):
    assert P.collocations(as_docs([])).count() == 0
    assert P.collocations(as_docs([("en", None), (None, " \t")])).count() == 0


@pytest.mark.parametrize("support", [4, 30])
def test_groups_send_only_what_can_reach_their_share(support):
    """Shards of one group: what a group names is bounded by its own bar, not by those of its shards."""
    rng = random.Random(5)
    blocks = []
    for _ in range(40):
        words = [rng.choice(["a", "b", "c", "of"] + [f"w{i}" for i in range(300)]) for _ in range(200)]
        blocks.append(P._pieces([" ".join(words).encode()]))
    counts = Counter()
    for data in blocks:
        words = data.decode().split()
        for k in (1, 2):
            counts.update(" ".join(words[i : i + k]) for i in range(len(words) - k + 1))
    n = [data.count(b" ") + data.count(b"\n") for data in blocks]
    squeeze = P.zstandard.ZstdCompressor().compress
    batch = P.pa.RecordBatch.from_pydict(
        {"lang": ["en"] * 40, "n": [sum(n)] * 40, "seed": [3] * 40, "words": n, "bytes": [len(d) for d in blocks], "data": [squeeze(d) for d in blocks]}
    )
    got = {}
    for shard_bytes in (1 << 20, 1 << 13):
        rows = [r for b in P._mine(support, 1, 2, shard_bytes)(iter([batch])) for r in b.to_pylist()]
        assert len({r["phrase"] for r in rows}) == len(rows)
        got[shard_bytes] = {r["phrase"]: (r["n"], support - 1 - r["told"]) for r in rows}
    whole, cut = got.values()
    assert whole == {p: (a, 0) for p, a in counts.items() if a >= support}
    assert set(cut) >= set(whole)
    for p, (n, rest) in cut.items():
        assert n <= counts[p] <= n + rest and n + rest >= support


@pytest.mark.parametrize("shard_bytes", [20000, 4000, 500])
def test_only_frequent_phrases_leave_the_shards(as_docs, monkeypatch, shard_bytes):
    """However many shards a language has, what their union names is each frequent phrase once."""
    monkeypatch.setattr(P.piece_blocks, "__defaults__", (300,))
    sent, stored = [], P.stored
    monkeypatch.setattr(P, "stored", lambda df, label, *by: sent.append((label, stored(df, label, *by))) or sent[-1][1])
    rows = [("en", text) for lang, text in corpus(11) if lang == "en"]
    found, _ = P.frequent_phrases(as_docs(rows), support=8, shard_bytes=shard_bytes)
    phrases = [r.phrase for r in found.collect()]
    assert len(set(phrases)) == len(phrases) > 100
    assert sum(df.count() for label, df in sent if label == "union") == len(phrases)


def test_one_shard_and_many_find_the_same(as_docs, monkeypatch):
    monkeypatch.setattr(P.piece_blocks, "__defaults__", (300,))
    docs = as_docs(corpus(12))
    whole, cut = (sorted(map(tuple, P.frequent_phrases(docs, support=5, shard_bytes=b)[0].collect())) for b in (1 << 20, 2000))
    assert whole == cut


def test_packs_and_hashes_that_collide():
    first = P.np.array([5, 5, 1 << 63, 5, (1 << 64) - 1], P.np.uint64)
    second = P.np.array([1, 2, 7, 1, 3], P.np.uint32)
    order, head = P._equal(first, second)
    assert P.np.diff(P.np.append(head, 5)).tolist() == [2, 1, 1, 1]
    assert sorted(order[:2].tolist()) == [0, 3]
    columns = [P.np.sort(first), second, P.np.arange(5), P.np.arange(5) + 70_000]
    got = P._unpacked(P._packed(*columns), 5)
    assert [x.tolist() for x in got] == [x.tolist() for x in columns]
    assert len(P._unpacked(P._packed(*(x[:0] for x in columns)), 0)[0]) == 0
