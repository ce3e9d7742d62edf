"""Word, token and pattern counts over text columns (AGG-10..12, FLT-5/7/10).

All are ``explode`` + ``groupBy().count()``: the count is partially aggregated
in every map task, so a word that appears in a third of all texts is reduced
locally before the shuffle.  Texts are processed whole.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Delimiters of the plain word count (the whitespace set of a
# default string tokenizer: space, tab, newline, carriage return, form feed).
WORD_DELIMITERS = r"[ \t\n\r\f]+"

# The stream tokeniser keeps ASCII letters, digits and spaces only.  The characters
# are listed one by one: such a class is a table look-up, one of ranges a chain of calls a character.
STREAM_KEEP_PATTERN = f"[^{string.ascii_letters}{string.digits} ]"


def word_count(df: DataFrame, c: str, lower: bool = False, min_len: int = 1,
               word_name: str = "word", count_name: str = "count") -> DataFrame:
    """AGG-10: case-sensitive by default; ``lower`` and ``min_len`` variants."""
    col = F.lower(F.col(c)) if lower else F.col(c)
    # explode then a plain filter: stays in whole-stage codegen (no lambda)
    w = (df.select(F.explode(F.split(col, WORD_DELIMITERS)).alias(word_name))
         .filter(F.col(word_name) != ""))
    if min_len > 1:
        w = w.filter(F.length(word_name) >= min_len)
    return w.groupBy(word_name).agg(F.count(F.lit(1)).alias(count_name))


def stream_tokens(c) -> Column:
    """STM-4 rule: drop every character but ASCII letters, digits and spaces,
    lower-case, split on whitespace."""
    col = F.col(c) if isinstance(c, str) else c
    return F.split(F.lower(F.regexp_replace(col, STREAM_KEEP_PATTERN, "")), r"\s+")


def token_word_count(df: DataFrame, c: str, min_len: int = 4) -> DataFrame:
    """STM-4 batch twin: tokens of at least ``min_len`` characters, counted."""
    w = df.select(F.explode(stream_tokens(c)).alias("word")).filter(F.length("word") >= min_len)
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def grep_count(df: DataFrame, c: str, pattern: str, name: str = "match",
               count_name: str = "count") -> DataFrame:
    """FLT-10: every match of ``pattern`` in the text, counted per distinct match."""
    m = df.select(F.explode(F.regexp_extract_all(F.col(c), F.lit(pattern), 0)).alias(name))
    return m.groupBy(name).agg(F.count(F.lit(1)).alias(count_name))


def lines(df: DataFrame, c: str, name: str = "line") -> DataFrame:
    """SRC-6 over a text column: one row per line."""
    return df.select(F.explode(F.split(F.col(c), "\n")).alias(name))


def token_count(df: DataFrame, c: str, contains: str, position: int, sep: str = " ",
                name: str = "token", count_name: str = "count") -> DataFrame:
    """AGG-12: lines containing ``contains`` grouped by their ``position``-th token.

    A missing token is null (``try_element_at``), not an error.
    """
    ln = lines(df, c).filter(F.col("line").contains(contains))
    tok = ln.select(F.try_element_at(F.split("line", sep), F.lit(position)).alias(name))
    return tok.groupBy(name).agg(F.count(F.lit(1)).alias(count_name))
