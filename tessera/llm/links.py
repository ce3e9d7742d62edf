"""From candidate pairs to components: full check on the texts, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut
from tessera.llm.shingles import linked, shingle_set, words_of

#: Up to so many ids (8 bytes each) are broadcast to pick their rows; more are joined.
BROADCAST_IDS = 200_000


def involved(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose id is in ``ids`` (id); few ids are broadcast."""
    ids = cut(ids.select("id").distinct())
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return texts.join(ids, "id", "left_semi")


def verify(pairs: DataFrame, texts: DataFrame, words: int, percent: int, salts: int = 16) -> DataFrame:
    """The pairs (a, b) whose full sets of ``words``-word shingles reach ``percent``.

    Each member's text meets its centre's once per (centre, salt), so a centre with very
    many partners is spread over ``salts`` tasks.
    """
    pairs = cut(pairs)
    salted = pairs.withColumn("salt", F.pmod(F.hash("b"), F.lit(salts)))
    asked = (salted.select(F.col("b").alias("id"), F.col("a").alias("centre"), "salt",
                           F.lit(1).alias("role"))
             .unionByName(salted.select(F.col("a").alias("id"), F.col("a").alias("centre"),
                                        "salt", F.lit(0).alias("role")).distinct()))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    rows = (asked.join(involved(texts, ids).select("id", "text"), "id")
            .repartition("centre", "salt").sortWithinPartitions("centre", "salt", "role"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sets = None, []
        for frame in batches:
            found = []
            for i, centre, salt, role, text in zip(frame["id"], frame["centre"], frame["salt"],
                                                   frame["role"], frame["text"]):
                if (centre, salt) != now:
                    now, sets = (centre, salt), []
                own = shingle_set(words_of(text), words)
                if role == 0:
                    sets.append(own)
                elif any(linked(own, s, percent) for s in sets):
                    found.append((centre, i))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return (rows.select("id", "centre", "salt", "role", "text")
            .mapInPandas(run, "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(id, component): smallest reachable id of every id in ``edges`` (a, b).

    Alternates two rounds until nothing changes: every id sends its larger neighbours, then
    its smaller ones, to the smallest neighbour it knows.  The edges never grow in number.
    Minima are partial before they are shuffled, and written out before they are joined, so
    that the rows of a hub with very many neighbours can be split over tasks.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                .where("hi <> lo").distinct())
    while True:
        # large star: larger neighbours of each id point at its least neighbour
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = cut(both.groupBy("hi").agg(F.min("lo").alias("m")).select(
            F.col("hi").alias("v"), F.least("hi", "m").alias("m")))
        large = cut(edges.select(F.col("lo").alias("v"), F.col("hi").alias("u")).join(least, "v")
                 .select(F.col("u").alias("hi"), F.col("m").alias("lo")).distinct())
        # small star: smaller neighbours, and the id itself, point at the least of them
        lows = cut(large.groupBy("hi").agg(F.min("lo").alias("m")))
        small = (large.join(lows, "hi").select(
            F.explode(F.array(F.struct(F.col("lo").alias("x"), "m"),
                              F.struct(F.col("hi").alias("x"), "m"))).alias("e"))
            .select(F.col("e.x").alias("hi"), F.col("e.m").alias("lo"))
            .where("hi <> lo").distinct())
        small = cut(small)
        if small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty():
            return small.groupBy("hi").agg(F.min("lo").alias("component")).select(
                F.col("hi").alias("id"), "component").unionByName(
                small.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())
        edges = small
