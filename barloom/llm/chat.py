"""Chat formatting: one training example for every assistant turn.

Turns are written as ``### role: text</turn>`` lines. Inside roles and texts the
characters of these marks are written as a backslash and a letter, so a text that
looks like a turn mark stays text, is read back as it was, and the output can be
cut at the marks alone.

Prefix-target expansion writes every example out: ``context`` is the whole formatted
conversation before an assistant turn's reply, with that turn's header, ``target`` the
reply, the only trainable part. ``context_start`` is 0; ``target_start`` and
``target_end`` delimit the reply in the example's text. A conversation of n turns so
gives text of the order of n * n turns, row by row: no list of examples is held, and
reading back keeps the replies and one text a conversation.

Defined cases: null text and null role are empty; rows of equal turn go by role,
then text; a null turn comes first; a null conv_id is a conversation of its own;
turns after the last reply, or a conversation without any, form a last row with
``target`` null. Only columns named here are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
MARK, COLON, END = "### ", ": ", "</turn>\n"
#: How a character of the marks is written inside a role or text, the backslash first.
ESCAPES = (("\\", r"\b"), ("#", r"\h"), (":", r"\c"), ("<", r"\l"))


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def format_turns(turns: DataFrame) -> DataFrame:
    """One row a turn: the formatted pieces, their place, and the example they belong to.

    Columns: conv_id, turn_no (from 1), trained, head, body, tail, start (characters
    before the turn), example (from 1).
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    shaped = turns.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
    ).select(
        "conv_id",
        "turn",
        "role",
        "text",
        (F.col("role") == TRAINED_ROLE).alias("trained"),
        F.concat(F.lit(MARK), escape(F.col("role")), F.lit(COLON)).alias("head"),
        escape(F.col("text")).alias("body"),
    )
    size = F.char_length("head") + F.char_length("body") + F.lit(len(END))
    return shaped.select(
        "conv_id",
        F.row_number().over(order).alias("turn_no"),
        "trained",
        "head",
        "body",
        F.lit(END).alias("tail"),
        F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0).cast("long")).alias("start"),
        (1 + F.coalesce(F.sum(F.col("trained").cast("long")).over(before), F.lit(0)))
        .cast("long")
        .alias("example"),
    )


def expand_examples(turns: DataFrame) -> DataFrame:
    """One row an assistant turn, and one for a conversation that does not end with one.

    Columns: conv_id, example, context (all turns before, and this reply's header),
    target (the escaped reply, trainable), closing, context_start, target_start,
    target_end. The row without target has the whole conversation as its context.
    """
    order = Window.partitionBy("conv_id").orderBy("turn_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = F.concat("head", "body", "tail")
    rows = format_turns(turns).select(
        "*",
        F.collect_list(whole).over(before).alias("earlier"),
        F.lead("turn_no").over(order).isNull().alias("ends"),
    )
    rows = rows.filter("trained or ends").select(
        "conv_id",
        "example",
        F.concat(F.array_join("earlier", ""), F.when(F.col("trained"), F.col("head")).otherwise(whole)).alias("context"),
        F.when(F.col("trained"), F.col("body")).alias("target"),
        F.when(F.col("trained"), F.col("tail")).otherwise(F.lit("")).alias("closing"),
    )
    start = F.char_length("context").cast("long")
    return rows.select(
        "conv_id",
        "example",
        "context",
        "target",
        "closing",
        F.lit(0).cast("long").alias("context_start"),
        start.alias("target_start"),
        (start + F.coalesce(F.char_length("target"), F.lit(0))).alias("target_end"),
    )


def _text() -> Column:
    """The whole text of an example, in which its offsets count."""
    return F.concat("context", F.coalesce("target", F.lit("")), "closing")


def full_examples(examples: DataFrame) -> DataFrame:
    """The examples to train on, each as one text: (conv_id, example, text, target_start, target_end)."""
    return examples.filter(F.col("target").isNotNull()).select(
        "conv_id", "example", _text().alias("text"), "target_start", "target_end"
    )


def digest(examples: DataFrame) -> DataFrame:
    """What the formatted output holds, read back from it, one row a conversation.

    The loss text is what the offsets mark in the text of every example, in order; the turns
    are those of the last example's text, whose prefixes the others are.
    """
    masked = F.substr("text", (F.col("target_start") + 1).cast("int"), (F.col("target_end") - F.col("target_start")).cast("int"))
    texts = examples.select("conv_id", "example", _text().alias("text"), "target_start", "target_end")
    rows = texts.select("conv_id", "example", "text", masked.alias("masked")).groupBy("conv_id").agg(
        F.max_by("text", "example").alias("formatted"),
        F.sort_array(F.collect_list(F.struct("example", "masked"))).alias("e"),
    )
    # what stands before each end mark is one turn: "### role: text"
    parsed = rows.select(
        "conv_id",
        "formatted",
        unescape(F.array_join("e.masked", "")).alias("loss"),
        F.filter(F.split("formatted", END), lambda x: x != "").alias("turns"),
    )
    role = lambda x: F.substring_index(x, COLON, 1)
    lines = F.transform(
        "turns",
        lambda x: F.concat(
            unescape(F.substr(role(x), F.lit(len(MARK) + 1))),
            F.lit("\n"),
            unescape(F.substr(x, F.char_length(role(x)) + F.lit(len(COLON) + 1))),
            F.lit("\n"),
        ),
    )
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha(F.array_join(lines, "")).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        sha(F.col("loss")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def marker_rows(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts are made of the template's own marks."""
    return spark.sql(
        r"select -7L conv_id, cast(id as bigint) turn, if(id = 0, 'user', 'assistant') role, "
        r"r'\### Assistant: </turn> ok' text from range(2)"
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the marker conversation, expanded, then read back."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return digest(expand_examples(turns.unionByName(marker_rows(spark))))


ORACLE_OP6 = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce("text", '') as body from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), f as (
  select *, length(role) + length(body) + 14
    + length(regexp_replace(role || body, '[^\\#:<]', '', 'g')) as size
  from t
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' order by turn, role, body)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(body) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then body else '' end, '' order by turn, role, body), '')) as loss_sha256,
  cast(sum(size) as bigint) as formatted_chars
from f group by conv_id
"""
