"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; adjacent turns of
one role are merged by an array aggregation; the parts are concatenated. The
template is ``<|turn|>role<|text|>text<|end|>``; a merged turn holds several
``<|text|>`` parts, so the turns that went in can be read back.

Control strings inside roles and texts are escaped by a backslash after their
first character (one more, if there are some already), which is undone on
reading: no escaped text holds a control string.

Defined results: turns sort by (turn, role, text), nulls first, so ties have
one order and repeated rows stay as repeated turns; a null role or text counts
as empty; rows with a null ``conv_id`` make up one conversation; an empty table
gives no rows; further columns of the input are ignored.

A formatted conversation is one string, so it must fit a row. A long
conversation reaches that row in sorted chunks of ``CHUNK`` turns that are
escaped on the way, so that no task gets all of its rows one by one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"

#: Control strings of this and other common templates.
CONTROL = r"([<\[])(\\*)(?=\||/?s>|/?INST\]|/?SYS>)"
ESCAPED = r"([<\[])\\(\\*)(?=\||/?s>|/?INST\]|/?SYS>)"

#: Turn numbers that meet in the first step of collecting.
CHUNK = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2")


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: what a lambda refers to from
    outside is worked out again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _merged(turns: Column) -> Column:
    """Adjacent turns of one role become one struct (role, texts)."""

    def cut(turns: Column) -> Column:
        is_first = lambda x, i: (i == 0) | (F.get(turns, i - 1)["role"] != x["role"])
        starts = F.filter(F.transform(turns, lambda x, i: F.when(is_first(x, i), i)), lambda i: i.isNotNull())
        return _once(starts, lambda starts: F.transform(starts, lambda i, k: message(turns, i, F.coalesce(F.get(starts, k + 1), F.size(turns)))))

    def message(turns: Column, start: Column, until: Column) -> Column:
        texts = F.transform(F.slice(turns, start + 1, until - start), lambda x: x["text"])
        return F.struct(F.get(turns, start)["role"].alias("role"), texts.alias("texts"))

    return _once(turns, cut)


def _prefix_sums(lengths: Column) -> Column:
    """Sums of all that stand before each element, in blocks of 64, so that
    long arrays don't cost the square of their length."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    sums = lambda a: F.aggregate(a, F.array(F.lit(0).cast("long")), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x)))
    cut = lambda a: F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / 64).cast("int")), lambda b: F.slice(a, b * 64 + 1, 64))
    inside = lambda a, base: F.transform(F.slice(sums(a), 1, F.size(a)), lambda x: x + base)
    joined = lambda blocks, before: F.flatten(F.transform(blocks, lambda a, b: _once(F.get(before, b), lambda base: inside(a, base))))
    return _once(_once(lengths, cut), lambda blocks: _once(sums(F.transform(blocks, total)), lambda before: joined(blocks, before)))


def format_chats(conversations: DataFrame, trained_role: str = "assistant", chunk: int = CHUNK) -> DataFrame:
    """conv_id, formatted, loss_spans (array of start, length in code points of
    ``formatted``, one for each text of ``trained_role``, in order) and
    n_messages (turns after merging)."""
    empty = F.lit("")
    turn = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    # Sorted as they are, then escaped.
    escaped = lambda x: F.struct(x["turn"].alias("turn"), escape(x["role"]).alias("role"), escape(x["text"]).alias("text"))
    part = F.floor(F.col("turn") / chunk)
    chunks = (
        conversations.select("conv_id", "turn", "role", "text")
        .groupBy("conv_id", part.alias("part"))
        .agg(F.transform(F.sort_array(F.collect_list(turn)), escaped).alias("turns"))
    )
    turns = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("part", "turns"))), lambda p: p["turns"]))
    convs = chunks.groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", _merged(F.col("turns")).alias("messages"))
    # The pieces of the output, each with whether it is trained on.
    pieces = F.flatten(
        F.transform(
            "messages",
            lambda m: F.concat(
                F.array(F.struct(F.concat(F.lit(TURN), m["role"]).alias("s"), F.lit(False).alias("loss"))),
                F.flatten(
                    F.transform(
                        m["texts"],
                        lambda t: F.array(
                            F.struct(F.lit(TEXT).alias("s"), F.lit(False).alias("loss")),
                            F.struct(t.alias("s"), (m["role"] == trained_role).alias("loss")),
                        ),
                    )
                ),
                F.array(F.struct(F.lit(END).alias("s"), F.lit(False).alias("loss"))),
            ),
        )
    )
    cut = convs.select("conv_id", F.size("messages").alias("n_messages"), pieces.alias("pieces")).withColumn(
        "starts", _prefix_sums(F.transform("pieces", lambda p: F.length(p["s"])))
    )
    span = lambda p, start: F.when(p["loss"], F.struct(start.alias("start"), F.length(p["s"]).alias("length")))
    spans = F.filter(F.zip_with("pieces", "starts", span), lambda s: s.isNotNull())
    return cut.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["s"]), "").alias("formatted"), spans.alias("loss_spans"), "n_messages")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds, unescaped."""
    blocks = F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1 << 30)
    parts = F.transform(blocks, lambda b: F.split(F.substring(b, F.lit(1), F.length(b) - len(END)), r"<\|text\|>"))
    return F.flatten(
        F.transform(
            parts,
            lambda p: F.transform(
                F.slice(p, 2, 1 << 30),
                lambda t: F.struct(unescape(F.get(p, F.lit(0))).alias("role"), unescape(t).alias("text")),
            ),
        )
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"]))), "")
