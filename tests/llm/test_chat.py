import hashlib

from barloom.llm import chat as C

TURNS = "conv_id long, turn long, role string, text string"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
    for conv in {r[0] for r in rows}:
        turns = sorted(((c, t, role or "", text or "") for c, t, role, text in rows if c == conv), key=key)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss))
    return out


ROWS = [
    (1, 0, "system", "be\nkind"), (1, 1, "user", "hi"), (1, 2, "assistant", "### user: </turn>\n\\b \\\\"), (1, 3, "user", "bye"),
    (2, 0, "user", "alone"), (3, 0, "assistant", None), (3, 1, "assistant", "é😀"), (4, 5, "user", ""), (4, 5, "assistant", "tie"),
    (4, 5, "assistant", "tie"), (5, None, None, ": #<\\"), (5, 1, "as:sist\nant", "no"), (None, 0, "user", "x"), (6, 0, "user", "long " * 50000),
    (6, 1, "assistant", "ok"),
]


def test_read_back(spark):
    df = spark.createDataFrame(ROWS, TURNS).selectExpr("*", "'x' as example", "1 as target")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digest(C.expand_examples(df)).collect()}
    assert got == brute(ROWS)


def test_every_reply_has_its_own_example(spark):
    df = spark.createDataFrame(ROWS[:4] + ROWS[5:7], TURNS)
    full = {(r.conv_id, r.example): r for r in C.full_examples(C.expand_examples(df)).collect()}
    assert set(full) == {(1, 1), (3, 1), (3, 2)}
    r = full[3, 2]
    assert r.text == "### assistant: </turn>\n### assistant: é😀</turn>\n"
    assert r.text[r.target_start : r.target_end] == "é😀"
    one = full[1, 1]
    assert one.text[: one.target_start].endswith("### assistant: ") and "bye" not in one.text


def written(text):
    for plain, mark in C.ESCAPES:
        text = text.replace(plain, mark)
    return text


def test_examples_hold_all_turns_before_their_reply(spark):
    rows = [(8, k, ("user", "assistant")[k % 2], f"turn # {k} </turn> \\é😀" * (k + 1)) for k in range(9)]
    examples = C.expand_examples(spark.createDataFrame(rows, TURNS))
    full = {r.example: r for r in C.full_examples(examples).collect()}
    turns = [f"### {role}: {written(text)}</turn>\n" for _, _, role, text in rows]
    assert sorted(full) == [1, 2, 3, 4]
    for example, r in full.items():
        before = "".join(turns[: 2 * example - 1]) + "### assistant: "
        assert r.text[: r.target_start] == before
        assert r.text[r.target_start : r.target_end] == written(rows[2 * example - 1][3])
    # the digest follows the offsets, not the stored target
    moved = examples.withColumn("target_end", examples.target_end - 1)
    assert C.digest(moved).first().loss_chars < C.digest(examples).first().loss_chars


def test_plan_is_native(spark, sf_dir):
    text = C.op6_chat_formatting(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_no_rows(spark):
    assert C.digest(C.expand_examples(spark.createDataFrame([], TURNS))).count() == 0


def test_expansion_writes_whole_contexts(spark):
    """Every row of the expansion holds all turns before its reply, also the last one without a reply."""
    rows = [(8, k, ("user", "assistant")[k % 2], f"say # {k}") for k in range(5)]
    turns = [f"### {role}: {written(text)}</turn>\n" for _, _, role, text in rows]
    got = {r.example: r for r in C.expand_examples(spark.createDataFrame(rows, TURNS)).collect()}
    assert [got[e].context for e in (1, 2)] == ["".join(turns[: 2 * e - 1]) + "### assistant: " for e in (1, 2)]
    assert (got[3].context, got[3].target) == ("".join(turns), None)
    assert all(r.target_start == len(r.context) for r in got.values())
