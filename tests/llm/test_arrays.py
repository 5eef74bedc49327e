import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import arrays as A

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t日A", max_size=30)), min_size=1, max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_and_hashes(rows):
    raw, offsets = A.text_bytes(pa.array(rows, pa.string()))
    buffer = A.padded(raw, lower=True)
    start, end, row = A.spans(A.NOT_SPACE[buffer[: len(raw)]], offsets)
    got = [[] for _ in rows]
    for s, e, r in zip(start, end, row):
        got[r].append(buffer[s:e].tobytes().decode())
    want = [(t or "").translate({65: 97}).replace("\n", " ").replace("\t", " ").split(" ") for t in rows]
    assert got == [[w for w in ws if w] for ws in want]
    hashes = A.span_hashes(buffer, start, end)
    words = [w for ws in got for w in ws]
    assert len(set(hashes.tolist())) == len(set(words))
    by_word = {}
    for w, h in zip(words, hashes.tolist()):
        assert by_word.setdefault(w, h) == h


def test_slices_of_a_column():
    column = pa.array(["aa", None, "b c", "d"]).slice(1, 2)
    raw, offsets = A.text_bytes(column)
    assert raw.tobytes() == b"b c" and offsets.tolist() == [0, 0, 3]


def test_long_words_hash_by_content():
    a, b = b"x" * 9000, b"x" * 8999 + b"y"
    buffer = A.padded(np.frombuffer(a + b + a, dtype=np.uint8))
    h = A.span_hashes(buffer, np.array([0, 9000, 18000]), np.array([9000, 18000, 27000]))
    assert h[0] == h[2] != h[1]


def test_counts_within_groups():
    counts, one = A.counts_within(np.array([0, 0, 0, 1]), np.array([5, 5, 6, 5], dtype=np.uint64))
    assert counts.tolist() == [2, 2, 1, 1] and one.sum() == 3
