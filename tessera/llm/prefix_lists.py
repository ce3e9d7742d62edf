"""Inverted lists over set prefixes: exact candidates of a Jaccard join, never a whole group's pairs.

Order the shingles of all sets in one way.  Sets of n <= m members that share at least
``t = least_overlap(n, m)`` have a common member among the first n - t + 1 of the one and
the first m - t + 1 of the other.  So the smaller set is looked up by its first
``n - least_overlap(n, n) + 1`` members (index) and the larger one looks with its first
``n - ceil(percent n / 100) + 1`` (probe).

The order is by how often a shingle occurs, then by hash: shingles that many sets share
come last and leave the prefixes, so a shared passage or template brings no candidates by
itself: two sets of one template meet in it only if the template alone makes them reach t.
Counts cover all sets; ``MOST_COMMON`` of the commonest are kept in order (a bounded
broadcast), the others count as equally rare.  The order is a matter of speed, not of results.

Pairs come in rounds.  First each list member meets a few centres among members of its
size.  After the links so found have joined sets into components, only lists that still
hold several components are scanned, and only for pairs across them: lists of up to LONG
rows as they are; the sets of longer ones are ordered anew, by counts of all their members
among themselves, and listed again (``links_across``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import byte_slices, cut, mix64
from tessera.llm.links import verify
from tessera.llm.shingles import hashed_sets, least_difference, parity_bitmaps

#: Shingles in more sets than COMMON are common; the MOST_COMMON commonest are kept in order
#: (16 bytes each on the driver and in each task).
COMMON, MOST_COMMON = 48, 1 << 19
CENTRES = 3
#: Mixed lists with more rows are made anew before they are scanned.
LONG = 2 * COMMON
#: Sets up to this size carry all their members along (for fixed-size subsets).
SMALL = 48


def _probe(n, percent: int):
    """Members a set of n is looked up with as the larger one."""
    return n - -(-percent * n // 100) + 1


def _ordered(hashes: np.ndarray, at: np.ndarray, common: tuple[np.ndarray, np.ndarray] | None):
    """Sort each set's hashes rare first; returns them with a mark on the common ones."""
    own = np.repeat(np.arange(len(at) - 1), np.diff(at))
    often = np.zeros(len(hashes), np.int64)
    if common is not None and len(common[0]):
        keys, counts = common
        place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        often = np.where(keys[place] == hashes, counts[place], 0)
    order = np.lexsort((hashes, often, own))
    return hashes[order], often[order] > 0


def common_shingles(texts: DataFrame, words: int, percent: int, whole: bool = False
                    ) -> tuple[np.ndarray, np.ndarray]:
    """(hash, sets it is in) of the commonest shingles, sorted by hash.

    Counted are, in every text, all members (``whole``), or those that can be in its prefix
    by hash and half as many again; partial counts are made per slice before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in byte_slices(batch, "text", 1 << 20):
                hashes, at = hashed_sets(data, offsets, words)
                sizes = np.diff(at)
                reach = sizes if whole else np.minimum(sizes, _probe(sizes, percent) * 3 // 2)
                rank = np.arange(len(hashes)) - np.repeat(at[:-1], sizes)
                keys, counts = np.unique(hashes[rank < np.repeat(reach, sizes)], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(counts)], names=["token", "n"])

    counted = (texts.select("text").mapInArrow(run, "token long, n long")
               .groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > COMMON))
    rows = counted.orderBy(F.desc("n"), "token").limit(MOST_COMMON).toPandas()
    keys = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows["n"].to_numpy(np.int64)[order]


def packed_sets(texts: DataFrame, words: int, percent: int, common) -> DataFrame:
    """(id, cls, n, bitmap, cold, tokens) of texts (id, text).

    ``cls`` names the word sequence (null without words), ``tokens`` are the prefix's hashes
    in order, the first ``cold`` of them not common.  Sets of up to SMALL carry all members.
    """
    import hashlib
    shared = texts.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offsets in byte_slices(batch, "text", 1 << 20):
                hashes, at = hashed_sets(data, offsets, words)
                sizes = np.diff(at)
                raw = data.tobytes()
                cls = [hashlib.md5(b" ".join(raw[a:b].lower().split())).digest() if n else None
                       for a, b, n in zip(offsets[:-1].tolist(), offsets[1:].tolist(), sizes.tolist())]
                maps = parity_bitmaps(hashes, at)
                ordered, often = _ordered(hashes, at, shared.value)
                keep = np.where(sizes <= SMALL, sizes, _probe(sizes, percent))
                inside = np.arange(len(ordered)) - np.repeat(at[:-1], sizes) < np.repeat(keep, sizes)
                ends = np.concatenate(([0], np.cumsum(keep)))
                rare = np.concatenate(([0], np.cumsum(~often[inside])))
                tokens = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                                  pa.array(ordered[inside].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(cls, pa.binary()), pa.array(sizes),
                     pa.array(maps, pa.binary()), pa.array((rare[ends[1:]] - rare[ends[:-1]])),
                     tokens], names=["id", "cls", "n", "bitmap", "cold", "tokens"])

    return texts.select("id", "text").mapInArrow(
        run, "id long, cls binary, n long, bitmap binary, cold long, tokens array<long>")


def representatives(packed: DataFrame) -> DataFrame:
    """One row per word sequence, under its smallest id."""
    return (packed.where("cls is not null and id is not null").groupBy("cls").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap"),
        F.first("cold").alias("cold"), F.first("tokens").alias("tokens")))


def _need(n: str, m: str, percent: int) -> Column:
    return F.expr(f"({percent} * ({n} + {m}) + {100 + percent - 1}) div {100 + percent}")


def _comparable(a: str, b: str, percent: int) -> Column:
    """Sides x<a>, x<b> of a list that can still reach the overlap from these places."""
    need = _need(f"n{a}", f"n{b}", percent)
    return ((F.least(f"n{a}", f"n{b}") * 100 >= F.greatest(f"n{a}", f"n{b}") * percent)
            & (F.col(f"pos{a}") + need <= F.col(f"n{a}")) & (F.col(f"pos{b}") + need <= F.col(f"n{b}")))


def shared_lists(reps: DataFrame, percent: int) -> DataFrame:
    """List rows (token, id, n, pos, len, centres) of the shingles that several sets are listed under.

    Rare shingles have short lists, counted in one shuffle; the lists of common ones are
    counted with partial aggregates and joined, so that a long one can be split.
    """
    entries = (reps.select("id", F.col("n").cast("int"), "cold", F.posexplode("tokens").alias("pos", "token"))
               .where(F.col("pos") <= F.col("n") - F.expr(f"({percent} * n + 99) div 100"))
               .withColumn("size", F.floor(F.log("n") / float(np.log(100 / percent))).cast("int")))
    centres = [F.min("id"), *[F.min_by("id", F.xxhash64(F.lit(c), "id")) for c in range(1, CENTRES)]]
    names = [f"c{c}" for c in range(CENTRES)]
    rare = entries.where("pos < cold").drop("cold").repartition("token")
    ranges = Window.partitionBy("token", "size")
    rare = (rare.select("*", *[c.over(ranges).alias(x) for c, x in zip(centres, names)])
            .withColumn("len", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("len > 1"))
    often = cut(entries.where("pos >= cold").drop("cold"))
    groups = often.groupBy("token", "size").agg(
        F.count(F.lit(1)).alias("k"), *[c.alias(x) for c, x in zip(centres, names)])
    lengths = often.groupBy("token").agg(F.count(F.lit(1)).alias("len")).where("len > 1")
    often = often.join(groups.drop("k"), ["token", "size"]).join(lengths, "token")
    columns = ["token", "id", "n", "pos", "len", *names]
    return rare.select(*columns).unionByName(often.select(*columns))


def star_pairs(lists: DataFrame) -> DataFrame:
    """Pairs of list members with the centres of their size."""
    return (lists.select("id", F.explode(F.array_distinct(F.array(
        *[f"c{c}" for c in range(CENTRES)]))).alias("c")).where("id <> c")
        .select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct())


def mixed_rows(lists: DataFrame, grouped: DataFrame) -> DataFrame:
    """Rows of lists that hold several components, with theirs and the list's commonest."""
    rows = lists.join(grouped, "id", "left").withColumn("component", F.coalesce("component", "id"))
    parts = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k"))
    mixed = (parts.groupBy("token").agg(F.count(F.lit(1)).alias("parts"),
                                        F.max_by("component", F.struct("k", "component")).alias("main"))
             .where("parts > 1").drop("parts"))
    return rows.join(mixed, "token")


def across_pairs(rows: DataFrame, percent: int, least_n: int = 0) -> DataFrame:
    """Pairs in one of the ``mixed_rows`` lists, in different components.

    The larger set probes, the smaller is indexed.  A list's commonest component is never
    scanned against itself.  Larger sets of up to ``least_n`` are left out.
    """
    index = rows.where(F.col("pos") <= F.col("n") - _need("n", "n", percent))
    minor = F.col("component") != F.col("main")

    def meet(larger: DataFrame, smaller: DataFrame) -> DataFrame:
        x = larger.where(F.col("n") > least_n).select("token", *[
            F.col(c).alias(f"{c}x") for c in ("id", "n", "pos", "component")])
        y = smaller.select("token", *[F.col(c).alias(f"{c}y") for c in ("id", "n", "pos", "component")])
        return (x.join(y, "token").where((F.col("componentx") != F.col("componenty"))
                                         & (F.col("nx") >= F.col("ny")) & _comparable("x", "y", percent))
                .select(F.least("idx", "idy").alias("a"), F.greatest("idx", "idy").alias("b")))

    # of two components one at least is not the commonest
    return (meet(rows.where(minor), index)
            .unionByName(meet(rows.where(~minor), index.where(minor))).distinct())


def plausible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and parity bitmaps leave the threshold possible; never drops a link."""
    side = reps.select("id", "n", "bitmap")
    both = (pairs.join(side.toDF("a", "na", "ma"), "a").join(side.toDF("b", "nb", "mb"), "b")
            .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))

    @F.pandas_udf("long")
    def apart(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([least_difference(p, q) for p, q in zip(x, y)], dtype="int64")

    most = F.col("na") + F.col("nb") - 2 * _need("na", "nb", percent)
    return both.where(apart("ma", "mb") <= most).select("a", "b")


def links_across(some: DataFrame, texts: DataFrame, grouped: DataFrame, words: int,
                 percent: int) -> DataFrame:
    """All links between different components among the documents of ``some`` (id, text)."""
    common = common_shingles(some, words, percent, whole=True)
    sets = cut(representatives(packed_sets(some, words, percent, common)))
    rows = cut(mixed_rows(shared_lists(sets, percent), grouped))
    return verify(plausible(across_pairs(rows, percent), sets, percent), texts, words, percent)


def subset_key(n: int, m: int, sums: np.ndarray) -> np.ndarray:
    """Key of fixed-size subsets, of sets of n <= m, from the sums of their members' hashes."""
    return mix64(sums + np.uint64((n << 32) + m)).view(np.int64)
