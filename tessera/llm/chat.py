"""Chat formatting: turn rows to one training text per conversation, and back.

Template, per run of adjacent turns of one role (a block):

    \\n<|start|>role \\n<|text|>first text \\n<|next|>second text ... \\n<|end|>

Control strings inside a role or text (the template's own and common ones of other
templates) get one backslash in front of the backslashes they already have, so "\\n" plus a
bare control string only ever comes from the template, and reading back is exact.

The loss mask is kept as segments: pieces of the formatted text in order, each marked as
trained on or not.  Only assistant texts are, without the control strings around them.

Null texts and roles are empty.  Turns with equal numbers are ordered by role and text, a
null number comes first; repeated rows are turns of their own.  Rows without a conversation
id form one conversation with a null id.  An empty table gives no rows.  Only the named
columns are read.  A conversation is one output value, so it is gathered in one task; its
size is bounded by what one string can hold, and all steps over it are linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, TEXT, NEXT, END = "<|start|>", "<|text|>", "<|next|>", "<|end|>"
#: Strings that are escaped inside texts.  Fixed values: the template's own and those of
#: widespread chat templates.
CONTROL = (START, TEXT, NEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
           "<|im_start|>", "<|im_end|>", "<|endoftext|>")


def _pattern() -> str:
    quoted = ["".join("\\" + c if c in "|[]" else c for c in s) for s in CONTROL]
    return "(?:" + "|".join(quoted) + ")"


ESCAPE = rf"(\\*{_pattern()})"
UNESCAPE = rf"\\(\\*{_pattern()})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1")


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", trained: str = "assistant") -> DataFrame:
    """(conv, formatted, segments): segments is array<struct<text, loss>>, in order."""
    said = turns.select(
        F.col(conv).alias("conv"), F.struct(
            F.col(turn).alias("turn"), escape(F.coalesce(role, F.lit(""))).alias("role"),
            escape(F.coalesce(text, F.lit(""))).alias("text")).alias("t"))
    lists = said.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def pieces(t: Column, i: Column) -> Column:
        before = F.when(i > 0, F.element_at("turns", F.greatest(i, F.lit(1)))["role"])
        opening = F.concat(F.when(i > 0, F.lit("\n" + END)).otherwise(F.lit("")),
                           F.lit("\n" + START), t["role"], F.lit("\n" + TEXT))
        control = F.when(t["role"] == before, F.lit("\n" + NEXT)).otherwise(opening)
        return F.array(F.struct(control.alias("text"), F.lit(False).alias("loss")),
                       F.struct(t["text"].alias("text"), (t["role"] == trained).alias("loss")))

    closing = F.array(F.struct(F.lit("\n" + END).alias("text"), F.lit(False).alias("loss")))
    segments = F.concat(F.flatten(F.transform("turns", pieces)), closing)
    return (lists.select(F.col("conv").alias(conv), segments.alias("segments"))
            .withColumn("formatted", F.array_join(F.col("segments.text"), ""))
            .select(conv, "formatted", "segments"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: array<struct<role, text>>, as they were before."""
    blocks = F.slice(F.split(formatted, _literal("\n" + START)), 2, 1 << 30)

    def turns(block: Column) -> Column:
        head = F.split(block, _literal("\n" + TEXT), 2)
        body = F.regexp_replace(head[1], _literal("\n" + END) + r"\z", "")
        return F.transform(F.split(body, _literal("\n" + NEXT)), lambda text: F.struct(
            unescape(head[0]).alias("role"), unescape(text).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def _literal(text: str) -> str:
    return text.replace("|", "\\|")


def loss_texts(segments: Column) -> Column:
    """The trained texts in order, unescaped."""
    return F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"]))
