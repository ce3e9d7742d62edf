"""Near-duplicate documents: SetSketch registers, banding, likelihood estimate, full check.

A document's set is its distinct shingles of five words (ASCII lower case; with fewer
words, the whole sequence; without words, nothing).  Two documents are linked if
``100 * |intersection| >= 85 * |union|`` (a parameter), and a component is what links
connect.

1. Rows with the same word sequence form one class; only its smallest id goes on.
2. Each class gets ``REGISTERS`` registers: the minimum of exponential hashes over the
   set, on a logarithmic scale with base ``B``, truncated to 16 bits.  Registers of a
   union are the per-register maxima, so sketches merge.
3. Bands of registers are hash keys.  In each bucket the members are paired with a few
   centres, never with each other.  The pair's likelihood over its registers gives an
   estimate; a pair that may reach the threshold is checked on the full shingle sets.
4. Members of buckets that still hold several components are joined exactly across the
   components (``prefix_lists``, with shingle counts among these members, so that what a
   template's documents share is looked at last), so no link depends on which centre was
   chosen and no bucket is paired with itself.

The chance that a pair at the threshold shares no band is (1 - 0.85**5)**32, below 1e-8.

Null or wordless texts have size 0 and are linked with nothing.  Rows with a null id get
a null component and are kept, and link nobody.  Repeated rows have equal results; two
texts under one id are one document for the links.  Only the id and text columns are
read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import prefix_lists, shingles
from tessera.llm.common import byte_slices, cut, mix64
from tessera.llm.links import components, involved, verify
from tessera.llm.shingles import words_of  # noqa: F401

SHINGLE_WORDS = 5
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
#: SetSketch parameters: base, rate of the exponentials, largest register value.
B, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
#: Similarity in percent; links need at least this much.
PERCENT = 85
#: Estimates this far (of 1) below the threshold are dropped: over five standard deviations.
SLACK = 0.15
CENTRES = 3

_MULTIPLIERS = mix64(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)
_OFFSETS = mix64(np.arange(1001, 1001 + REGISTERS, dtype=np.uint64))


def shingle_set(words: list[bytes]) -> set[bytes]:
    return shingles.shingle_set(words, SHINGLE_WORDS)


def linked(x: set, y: set, percent: int = PERCENT) -> bool:
    return shingles.linked(x, y, percent)


def registers_of(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SetSketch registers of each non-empty set hashes[at[i]:at[i+1]], one row per set."""
    out = np.empty((len(at) - 1, REGISTERS), np.uint16)
    for r in range(REGISTERS):
        low = np.minimum.reduceat(mix_once(hashes, r), at[:-1])
        unit = (low >> np.uint64(11)).astype(np.float64) / float(1 << 53)
        least = -np.log1p(-np.minimum(unit + 2.0 ** -54, 1 - 2.0 ** -53)) / RATE
        value = np.floor(1 - np.log(least) / np.log(B))
        out[:, r] = np.clip(value, 0, TOP + 1).astype(np.uint16)
    return out


def mix_once(hashes: np.ndarray, r: int) -> np.ndarray:
    x = (hashes ^ _OFFSETS[r]) * _MULTIPLIERS[r]
    return x ^ (x >> np.uint64(32))


def merge(registers_a: np.ndarray, registers_b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(registers_a, registers_b)


def band_keys(registers: np.ndarray) -> np.ndarray:
    banded = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), banded.shape[:2])
    for r in range(ROWS):
        h = mix64(h * np.uint64(0x100000001B3) + banded[:, :, r])
    return h.view(np.int64)


def likeliest_jaccard(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs from how their registers compare.

    With u and v the sets' shares of the summed sizes, a register of the first exceeds the
    second's with probability p(u - v J), is below with p(v - u J), where
    p(x) = -log_B(1 - x (B - 1) / B).
    """
    more, less = (ra > rb).sum(1), (ra < rb).sum(1)
    same = ra.shape[1] - more - less
    u = na / (na + nb)
    v = 1 - u
    top = np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-np.maximum(x, 0) * (B - 1) / B) / np.log(B)

    def gain(j):
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return (more * np.log(up + tiny) + less * np.log(down + tiny)
                + same * np.log(np.maximum(1 - up - down, tiny)))

    lo, hi = np.zeros_like(top), top.copy()
    for _ in range(40):  # the likelihood is concave in J: ternary search
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        left = gain(a) >= gain(b)
        lo, hi = np.where(left, lo, a), np.where(left, b, hi)
    return (lo + hi) / 2


def sketch(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(id, cls, n_shingles, registers, keys) of every row; cls names the word sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offsets in byte_slices(batch, "text", 1 << 20):
                hashes, at = shingles.hashed_sets(data, offsets, SHINGLE_WORDS)
                sizes = np.diff(at)
                full = np.flatnonzero(sizes)
                raw = data.tobytes()
                cls = [hashlib.md5(b" ".join(raw[a:b].lower().split())).digest() if n else None
                       for a, b, n in zip(offsets[:-1].tolist(), offsets[1:].tolist(),
                                          sizes.tolist())]
                regs: list = [None] * len(sizes)
                keys: list = [None] * len(sizes)
                if len(full):
                    r = registers_of(hashes, np.append(at[full], at[-1]))
                    for k, row, key_row in zip(full.tolist(), r, band_keys(r)):
                        regs[k], keys[k] = row.tobytes(), key_row
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(cls, pa.binary()), pa.array(sizes),
                     pa.array(regs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["id", "cls", "n_shingles", "registers", "keys"])

    return df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id long, cls binary, n_shingles long, registers binary, keys array<long>")


def _estimate(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose size ratio and likelihood leave the threshold possible."""
    side = reps.select("id", "n_shingles", "registers")
    both = (pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b")
            .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))

    @F.pandas_udf("double")
    def jaccard(ra: pd.Series, rb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        if not len(ra):
            return pd.Series([], dtype="float64")
        x = np.frombuffer(b"".join(ra), np.uint16).reshape(-1, REGISTERS)
        y = np.frombuffer(b"".join(rb), np.uint16).reshape(-1, REGISTERS)
        return pd.Series(likeliest_jaccard(x, y, na.to_numpy(float), nb.to_numpy(float)))

    return (both.where(jaccard("ra", "rb", "na", "nb") >= percent / 100 - SLACK)
            .select("a", "b").distinct())


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id",
                    percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept, cls) for every row of ``df``.

    ``kept`` marks the rows whose id is their component's smallest.
    """
    every = cut(sketch(df, text, key))
    reps = cut(every.where("cls is not null and id is not null").groupBy("cls").agg(
        F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"),
        F.first("registers").alias("registers"), F.first("keys").alias("keys")))
    texts = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    members = reps.select(F.explode("keys").alias("key"), "id")
    centres = (members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("c0"),
        *[F.min_by("id", F.xxhash64(F.lit(c), "id")).alias(f"c{c}") for c in range(1, CENTRES)])
        .where("n > 1"))
    shared = cut(members.join(centres, "key").drop("n"))
    stars = (shared.select("id", F.explode(F.array_distinct(F.array(
        *[f"c{c}" for c in range(CENTRES)]))).alias("c")).where("id <> c")
        .select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct())
    likely = cut(_estimate(stars, reps, percent))
    links = cut(verify(likely, texts, SHINGLE_WORDS, percent))
    # rows of one class follow its representative; the classes were written out above, so
    # that both sides of the join are plain exchanges and a class of very many copies is split
    twins = (every.where("cls is not null").select("cls", F.col("id").alias("b"))
             .join(reps.select("cls", F.col("id").alias("a")), "cls")
             .where("a <> b").select("a", "b").distinct())
    grouped = cut(components(links))

    # members of buckets that still hold several components are joined exactly across them
    labelled = shared.select("key", "id").join(grouped, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    mixed = (labelled.groupBy("key").agg(F.min("component").alias("lo"),
                                         F.max("component").alias("hi")).where("lo < hi"))
    unsettled = cut(labelled.join(mixed.select("key"), "key", "left_semi").select("id").distinct())
    if not unsettled.isEmpty():
        links = links.unionByName(cut(prefix_lists.links_across(
            involved(texts, unsettled), texts, grouped, SHINGLE_WORDS, percent)))
    final = components(links.unionByName(twins.select("a", "b")))
    return (every.select("id", "n_shingles", "cls").join(final, "id", "left")
            .withColumn("component_id", F.coalesce("component", "id"))
            .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
            .select("id", "n_shingles", "component_id", "kept", "cls"))
