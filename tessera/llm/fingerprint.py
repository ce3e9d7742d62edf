"""Lempel-Ziv phrase fingerprints.

A text is parsed left to right into phrases, each the longest phrase known so far plus one
character (LZ78).  The phrases' hashes are a set; its ``SIZE`` smallest members are the
fingerprint, written in hex.  Texts that compress well given each other share phrases, so
the likeness of two fingerprints (the share of common members among the smallest of their
union) tells similar texts from different ones.

The dictionary starts anew when it holds ``PHRASES`` phrases, at a place that depends on the
text alone, in however many parts it is read; the fingerprint goes on over the whole text, so
memory is bounded for texts of any length.

Null and empty texts have no phrases and an empty fingerprint; two empty ones are alike
(1.0), an empty and another are not (0.0).  Equal texts have equal fingerprints.  An empty
table gives an empty result; only the key and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, mix64

SIZE = 64
PHRASES = 1 << 18
_MULTIPLIER, _MASK = 0x100000001B3, (1 << 64) - 1
_EMPTY = np.zeros(0, np.uint32)


class Parse:
    """An LZ78 parse that can be continued, copied and fingerprinted."""

    __slots__ = ("phrases", "node", "least")

    def __init__(self, phrases: set[int] | None = None, node: int = 0, least=_EMPTY):
        self.phrases, self.node, self.least = phrases if phrases is not None else set(), node, least

    def copy(self) -> Parse:
        return Parse(set(self.phrases), self.node, self.least)

    def feed(self, text: str) -> Parse:
        phrases, node = self.phrases, self.node
        add = phrases.add
        at = 0
        while at < len(text):
            # a character adds one phrase at most, so the dictionary is full at the end of a
            # slice or not at all: where it starts anew depends on the text alone
            end = at + PHRASES - len(phrases)
            for c in map(ord, text[at:end]):
                node = (node * _MULTIPLIER + c + 1) & _MASK
                if node not in phrases:
                    add(node)
                    node = 0
            at = end
            if len(phrases) == PHRASES:
                self.least = self.smallest()
                phrases.clear()
        self.node = node
        return self

    def smallest(self) -> np.ndarray:
        """The smallest distinct 32-bit hashes of all phrases so far, ascending."""
        fresh = np.fromiter(self.phrases, np.uint64, len(self.phrases))
        values = np.concatenate((self.least, (mix64(fresh) >> np.uint64(32)).astype(np.uint32)))
        if len(values) > 4 * SIZE:
            values = np.partition(values, 3 * SIZE)[:3 * SIZE]
        return np.unique(values)[:SIZE]


def to_hex(least: np.ndarray) -> str:
    return least.astype(">u4").tobytes().hex()


def from_hex(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def fingerprint(text: str | None) -> str:
    return to_hex(Parse().feed(text or "").smallest())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the phrase sets behind two fingerprints."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:SIZE]
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, common, assume_unique=True).sum() / len(union))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every row; no shuffle."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="object")

    return docs.select(key, run(F.col(text)).alias("fingerprint"))


def spliced(own: str, following: str) -> tuple[str, str]:
    """(kept head, new tail): the last half of the code points is replaced by as many first
    ones of the following text, or all it has."""
    half = len(own) // 2
    return own[:len(own) - half], following[:half]


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text",
                      ranges: int | None = None) -> DataFrame:
    """Every row beside the next one in descending key order (after the last: the first).

    Returns (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next).  Null keys come last; rows of one key are ordered by their text's hash.

    Keys are cut into ranges on narrow rows.  Each row goes to its range, and the first row
    of a range also to the range before, so each range can be read alone, in order, keeping
    two rows in memory.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("id").desc_nulls_last(), F.col("tie")]
    placed = cut(rows.select("id", "tie").repartitionByRange(ranges, *order)
                 .withColumn("range", F.spark_partition_id()))
    # the first row of each range: one small row per range comes to the driver
    firsts = sorted(
        (tuple(r) for r in placed.groupBy("range").agg(
            # the largest id, then the smallest tie; -1 - tie turns the order round
            F.max(F.struct("id", (-1 - F.col("tie")).alias("t"))).alias("m"))
            .select("range", "m.id", (-1 - F.col("m.t")).alias("tie")).collect()), key=lambda r: r[0])
    starts = [_rank(i, t) for _, i, t in firsts]

    @F.pandas_udf("array<struct<range int, tail int>>")
    def targets(ids: pd.Series, ties: pd.Series) -> pd.Series:
        out = []
        for i, t in zip(ids, ties):
            rank = _rank(None if pd.isna(i) else int(i), int(t))
            at = _last_not_above(starts, rank)
            where = [(at, 0)]
            if starts[at] == rank:
                where.append(((at - 1) % len(starts), 1))
            out.append(where)
        return pd.Series(out)

    # ids go to Python as text, so that nulls do not turn them into floats
    dealt = (rows.withColumn("to", F.explode(targets(F.col("id").cast("string"), "tie")))
             .select("id", "tie", "text", F.col("to.range").alias("range"), F.col("to.tail").alias("tail"))
             # by range, as two ranges that hash alike would double a task's work
             .repartitionByRange(max(1, len(starts)), "range")
             .sortWithinPartitions("range", "tail", *order))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before: tuple | None = None  # range, id, text, parse of the whole text, sketch
        for frame in batches:
            out = []
            for where, tail, i, t in zip(frame["range"], frame["tail"], frame["id"], frame["text"]):
                t = t or ""
                half = Parse().feed(t[:len(t) - len(t) // 2])
                whole = half.copy().feed(t[len(t) - len(t) // 2:]).smallest()
                if before is not None and before[0] == where:
                    out.append(_row(before, t, whole))
                before = None if tail else (where, i, t, half, whole)
            yield pd.DataFrame(out, columns=["id", "n_chars", "edited_sha256", "fingerprint",
                                             "edited_fingerprint", "near_edited", "near_next"])

    found = dealt.select("range", "tail", F.col("id").cast("string").alias("id"), "text").mapInPandas(
        run, "id string, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")
    return found.withColumn("id", F.col("id").cast("long")).withColumnRenamed("id", key)


def _rank(i: int | None, tie: int) -> tuple:
    return (i is None, -(i or 0), tie)


def _last_not_above(starts: list[tuple], rank: tuple) -> int:
    lo, hi = 0, len(starts)
    while lo < hi:
        mid = (lo + hi) // 2
        if starts[mid] <= rank:
            lo = mid + 1
        else:
            hi = mid
    return max(0, lo - 1)


def _row(before: tuple, following: str, following_least: np.ndarray) -> tuple:
    _, i, own, half, least = before
    head, tail = spliced(own, following)
    edited = half.feed(tail).smallest()
    digest = hashlib.sha256((head + tail).encode()).hexdigest()
    return (i, len(own), digest, to_hex(least), to_hex(edited),
            likeness(least, edited), likeness(least, following_least))
