import hashlib
import random
import time

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from barloom.llm import bpe as B

from .conftest import ODD_ROWS

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return B.Codec(B.read_ranks(PATH), P.PATTERN)


@pytest.fixture(scope="module")
def own():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={})


def test_same_ids_as_the_library(codec, own):
    rng = random.Random(1)
    parts = ["a", "b", "ab", "the", "\n", " ", "\t", "é", "日本", "\x1c", "\x85", "​", "　", "😀", "1", "²", "!!!", "'s", "'S", "\x00", "ǅ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["", "a" * 4000, "ab" * 2000, "!" * 2001, " " * 900 + "x", "".join(rng.choice("abcdefghij") for _ in range(3000)), "<|endoftext|>"]
    for text, ids in zip(texts, codec.encode_batch(texts, batch_chars=5000), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_one_long_piece_takes_no_square(codec, own):
    rng = random.Random(3)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    started = time.perf_counter()
    (ids,) = codec.encode_batch([text])
    assert time.perf_counter() - started < 60
    assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text)
    texts = ["x" * 300_000, "日本語の文" * 5000, "".join(rng.choices("ACGT", k=65)), "".join(rng.choices("ab", k=50_000))]
    for text, ids in zip(texts, codec.encode_batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text)


def test_ranks_out_of_order():
    """Tokens whose ranks are below those of their parts: after each merge a lower rank may come up."""
    rng = random.Random(4)
    words = {bytes([b]) for b in range(256)}
    words |= {bytes(rng.choices(b"abc", k=k)) for k in (2, 2, 2, 2, 3, 3, 3, 3, 3, 4, 4, 4, 5, 5, 6) for _ in range(3)}
    order = sorted(words)
    rng.shuffle(order)
    ranks = {w: i for i, w in enumerate(order)}
    codec = B.Codec(ranks, r"\p{L}+")
    assert codec.reach.any()
    own = tiktoken.Encoding("odd", pat_str=r"\p{L}+", mergeable_ranks=ranks, special_tokens={})
    texts = ["".join(rng.choices("abc", k=rng.randrange(1, 400))) for _ in range(300)] + ["".join(rng.choices("abc", k=20_000))]
    for text, ids in zip(texts, codec.encode_batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text)


def test_a_full_cache_changes_nothing(codec, own, monkeypatch):
    monkeypatch.setattr(B, "CACHE_PIECES", 10)
    texts = [f"some {i} other words{i * 7}" for i in range(50)]
    got = [np.frombuffer(x, "<u4").tolist() for x in codec.encode_batch(texts, batch_chars=40)]
    assert got == [own.encode_ordinary(t) for t in texts]


def test_pair_table():
    rng = random.Random(2)
    pairs = {(rng.randrange(500), rng.randrange(500)): i for i in range(3000)}
    table = B.PairTable(pairs)
    left, right = np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])
    assert table.get(left, right).tolist() == list(pairs.values())
    assert (table.get(left + 1000, right) == B._NO_RANK).all()
    assert (table.get(np.array([-1]), np.array([1])) == B._NO_RANK).all()


def test_query_forms(make_docs, own):
    docs = make_docs(ODD_ROWS, extra=True)
    got = sorted(map(tuple, B.round_trip(docs, PATH, P.PATTERN).collect()), key=str)
    want = []
    for i, t in ODD_ROWS:
        ids = own.encode_ordinary(t or "")
        packed = np.array(ids, "<u4").tobytes()
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    encoded = B.encode(docs, PATH, P.PATTERN)
    back = B.decode(encoded, PATH, P.PATTERN)
    assert sorted(bytes(r.decoded) for r in back.collect()) == sorted((t or "").encode() for _, t in ODD_ROWS)
    assert B.round_trip(make_docs([]), PATH, P.PATTERN).count() == 0
