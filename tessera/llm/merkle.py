"""Merkle manifest of a table: trees per group, one root, a membership proof of every row.

``H`` is the lower-case hex SHA-256 of its inputs one after the other, digests as hex
text.  The leaves of a tree are ordered; while several nodes remain, every two neighbours
(the last run may be one) become their ``H``.  What remains is the tree's top; the tops,
ordered by tree, are the leaves of one last tree whose top is the root.

Proofs are made as in an octopus multiproof, for many leaves at a time:

1. Leaves are numbered within their tree and cut into leaf partitions, aligned runs of
   ``2**bits`` leaves.  Each gives one node; these are combined ``2**UP_BITS`` at a time
   until every tree has its top.
2. Each leaf partition computes the minimal union of the node coordinates its leaves lack
   (``missing``), and one join fetches them all, once per leaf partition.
3. The partition derives the interior nodes its leaves share and writes each leaf's own
   path from them.

A path is an array of one string per level: L or R (the side of the sibling) and the
sibling's digest, or N where the node has no sibling.  ``folded`` recomputes a root from a
digest and a path with SQL functions alone, apart from the code that built the tree.

Texts are hashed where they are read and never shuffled; a row's trace is its key and
digests.  Nulls are values of their own (encoded ``-``), null groups and null keys come
first.  Rows that repeat a key are ordered by digest; equal rows are leaves each.  Empty
texts are ``0:``; very long ones are hashed whole.  An empty table gives an empty result.
Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut

#: Most leaves of a leaf partition, and how many nodes are combined in one group, as powers of 2.
MOST_BITS, UP_BITS = 12, 12


def encoded(value) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = F.col(value).cast("string") if isinstance(value, str) else value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return max(0, (int(n) - 1).bit_length())


def _height(n: str) -> Column:
    return F.expr(f"case when {n} <= 1 then 0 else length(bin({n} - 1)) end")


def missing(known: np.ndarray, size: int, level: int = 0) -> list[tuple[int, int]]:
    """(level, index) of the fewest nodes that, with the known ones, give the top.

    ``known`` are sorted indices on ``level``, which has ``size`` nodes.
    """
    out = []
    while size > 1:
        beside = known ^ 1
        lacking = np.setdiff1d(beside[beside < size], known)
        out += [(level, int(i)) for i in lacking]
        known, size, level = np.unique(known >> 1), (size + 1) // 2, level + 1
    return out


def combine(nodes: list[str], steps: int) -> list[list[str]]:
    """The nodes and the ``steps`` levels above them."""
    levels = [nodes]
    for _ in range(steps):
        below = levels[-1]
        levels.append([digest(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


@dataclass
class Forest:
    """Numbered leaves, the nodes from the leaf partitions' up, and the tops of the trees."""
    leaves: DataFrame
    bits: int
    base: DataFrame
    nodes: DataFrame
    tops: DataFrame


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos`` (from 0 within ``tree``, ordered) and ``n`` (leaves of the tree).

    Rows are dealt by range and written once, so a row's partition and place in it stay;
    one row per partition and tree carries the counts before it.
    """
    dealt = cut(cut(rows).repartitionByRange("tree", *order).sortWithinPartitions("tree", *order))
    dealt = dealt.withColumn("_at", F.monotonically_increasing_id())
    dealt = dealt.withColumn("_part", F.shiftright("_at", 33))
    runs = dealt.groupBy("_part", "tree").agg(F.min("_at").alias("_first"),
                                              F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("tree").orderBy("_part")
    runs = cut(runs.select("_part", "tree", "_first",
                           (F.sum("_rows").over(before) - F.col("_rows")).alias("_base"),
                           F.sum("_rows").over(Window.partitionBy("tree")).alias("n")))
    return (dealt.join(runs, ["_part", "tree"])
            .withColumn("pos", F.col("_base") + F.col("_at") - F.col("_first"))
            .drop("_at", "_part", "_first", "_base"))


def build(rows: DataFrame, order: list[str]) -> Forest:
    """The trees over rows (tree, leaf, ...), the leaves of each in the given order."""
    leaves = cut(numbered(rows, order))
    counts = leaves.agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n")).first()
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(MOST_BITS, max(4, (counts.rows // (4 * parts)).bit_length()))
    leaves = leaves.withColumn("part", F.shiftright("pos", bits))
    schema = "tree string, level int, idx long, n long, hash string"

    def up(step: int, level: int, group: str):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("at")
            n, first = int(frame["n"].iloc[0]), int(frame[group].iloc[0])
            levels = combine(frame["hash"].tolist(), min(step, max(0, height(n) - level)))
            rows = [(frame["tree"].iloc[0], level + k, (first << step >> k) + i, n, h)
                    for k, nodes in enumerate(levels) for i, h in enumerate(nodes)]
            # of a leaf partition only its uppermost node is kept: the others can be derived
            return pd.DataFrame(rows[-1:] if level == 0 else rows[len(levels[0]):],
                                columns=["tree", "level", "idx", "n", "hash"])
        return run

    base = cut(leaves.select("tree", "part", F.col("pos").alias("at"), "n", F.col("leaf").alias("hash"))
               .groupBy("tree", "part").applyInPandas(up(bits, 0, "part"), schema))
    every, level, front = base, bits, base
    while level < height(counts.n or 0):
        front = (front.where((F.col("level") == level) & (_height("n") > level))
                 .select("tree", F.shiftright("idx", UP_BITS).alias("part"),
                         F.col("idx").alias("at"), "n", "hash"))
        front = cut(front.groupBy("tree", "part").applyInPandas(up(UP_BITS, level, "part"), schema))
        every, level = every.unionByName(front), level + UP_BITS
    tops = every.where((F.col("idx") == 0) & (F.col("level") == _height("n"))).select(
        "tree", F.col("hash").alias("top"))
    return Forest(leaves, bits, base, every, tops)


def prove(forest: Forest, carry: list[str], above: DataFrame | None = None) -> DataFrame:
    """(tree, pos, n, leaf, top, root, path, *carry) of every leaf.

    ``above`` (tree, path, root) continues the paths of whole trees to a common root.
    """
    bits = forest.bits
    parts = forest.base.select("tree", F.col("idx").alias("part"), "n")

    def ask(frames):
        for frame in frames:
            rows = []
            for tree, part, n in zip(frame["tree"], frame["part"], frame["n"]):
                level = min(bits, height(n))
                rows += [(tree, part, lv, i) for lv, i in
                         missing(np.array([part]), -(-n >> level), level)]
            yield pd.DataFrame(rows, columns=["tree", "part", "level", "idx"])

    asked = parts.mapInPandas(ask, "tree string, part long, level int, idx long")
    got = (asked.join(forest.nodes.select("tree", "level", "idx", "hash"), ["tree", "level", "idx"])
           .groupBy("tree", "part").agg(F.sort_array(F.collect_list(
               F.struct("level", "idx", "hash"))).alias("got")))
    if above is None:
        above = forest.tops.select("tree", F.array().cast("array<string>").alias("path"),
                                   F.col("top").alias("root"))
    shared = (parts.join(forest.tops, "tree").join(above, "tree")
              .join(got, ["tree", "part"], "left")
              .select("tree", "part", "top", "root", F.col("path").alias("over"),
                      F.col("got.level").alias("levels"), F.col("got.idx").alias("indices"),
                      F.col("got.hash").alias("hashes")))
    rows = forest.leaves.select("tree", "part", "pos", "n", "leaf", *carry)
    fields = {f.name: f for f in rows.schema.fields}
    schema = ", ".join([f"{c} {fields[c].dataType.simpleString()}"
                        for c in ["tree", "pos", "n", "leaf", *carry]]
                       + ["top string, root string, path array<string>"])

    def expand(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        mine, info = mine.sort_values("pos"), theirs.iloc[0]
        n, part = int(mine["n"].iloc[0]), int(mine["part"].iloc[0])
        steps = min(bits, height(n))
        levels = combine(mine["leaf"].tolist(), steps)
        fetched = {} if info["levels"] is None else dict(
            zip(zip(info["levels"], info["indices"]), info["hashes"]))
        # the way from this partition's node to the root is the same for all of its leaves
        upper = []
        for level in range(steps, height(n)):
            node = part >> (level - steps)
            upper.append(("R", "L")[node & 1] + fetched[level, node ^ 1]
                         if (level, node ^ 1) in fetched else "N")
        upper += list(info["over"])
        paths = []
        for i in range(len(mine)):
            path = []
            for nodes in levels[:-1]:
                path.append(("R", "L")[i & 1] + nodes[i ^ 1] if i ^ 1 < len(nodes) else "N")
                i >>= 1
            paths.append(path + upper)
        out = mine[["tree", "pos", "n", "leaf", *carry]].copy()
        out["top"], out["root"], out["path"] = info["top"], info["root"], paths
        return out

    return (rows.groupBy("tree", "part").cogroup(shared.groupBy("tree", "part"))
            .applyInPandas(expand, schema))


def folded(claim: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    def step(at, sibling):
        side, other = F.substring(sibling, 1, 1), F.substr(sibling, F.lit(2))
        return F.sha2(F.when(side == "L", F.concat(other, at)).otherwise(F.concat(at, other)), 256)
    return F.aggregate(path, claim, step)


def siblings(path: Column) -> Column:
    """The digests of a path, one after the other."""
    return F.array_join(F.transform(path, lambda s: F.substr(s, F.lit(2))), "")


def manifest(rows: DataFrame, group: Column, order: list[str], leaf: Column,
             carry: dict[str, Column]) -> DataFrame:
    """Proofs of every row: (leaf, top, root, path, *carry); trees by ``group``, null first."""
    tree = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    keys = {f"_k{i}": F.col(c) for i, c in enumerate(order)}
    leaves = rows.select(tree.alias("tree"), leaf.alias("leaf"),
                         *[c.alias(k) for k, c in keys.items()],
                         *[c.alias(f"_c{i}") for i, c in enumerate(carry.values())])
    low = build(leaves, [*keys, "leaf"])
    high = build(low.tops.select(F.lit("").alias("tree"), F.col("top").alias("leaf"),
                                 F.col("tree").alias("name")), ["name"])
    above = prove(high, ["name"]).select(F.col("name").alias("tree"), "path", "root")
    found = prove(low, [f"_c{i}" for i in range(len(carry))], cut(above))
    return found.select("leaf", "top", "root", "path", "pos", "n",
                        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)])
