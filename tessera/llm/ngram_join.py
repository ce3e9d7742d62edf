"""Jaccard join of documents on word n-grams by a size-aware heavy-light scheme.

A document's set is its distinct shingles of ``words`` words (ASCII lower case; with fewer
words, the whole sequence; without words, nothing).  Two link if ``100 * |intersection| >=
percent * |union|``.  Copies of a word sequence are one class and go on as one set.

* Light sets (up to ``boundary`` members) are joined through fixed-size subsets: for sizes
  n <= m the overlap that links is ``least_overlap(n, m)``; every subset of that size of
  either set is a key, and sets link exactly if they share a key.
* Heavy sets scan inverted lists (``prefix_lists``): a pair's larger member probes with its
  prefix, the smaller one is listed by its own.
* The boundary is the size at which both cost the least: subsets a light set would write
  against the list rows a heavy one reads, counted on the table.

Candidates are confirmed on the full texts.  Null or wordless texts have size 0 and link
with nothing.  Rows without an id have no component and link nobody.  Rows that repeat an id
have equal components; two texts under one id are one document for the links.  Very long
texts are hashed whole.  An empty table gives an empty result.  Only the id and the text are
read, so other columns cannot clash.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import prefix_lists as lists
from tessera.llm.common import cut
from tessera.llm.links import components, involved, verify
from tessera.llm.shingles import least_overlap

WORDS, PERCENT = 4, 85


def partner_sizes(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subset_count(n: int, percent: int) -> int:
    """Keys a light set of n members writes."""
    return sum(comb(n, least_overlap(n, m, percent)) for m in partner_sizes(n, percent)
               if least_overlap(n, m, percent) <= n)


def boundary(sizes: dict[int, int], scanned: float, percent: int) -> int:
    """The largest light size: the least of subsets written up to it and list rows read beyond."""
    best, at, cost = 0.0, 0, 0.0
    for n in range(1, lists.SMALL + 1):
        cost += sizes.get(n, 0) * (subset_count(n, percent)
                                   - lists._probe(n, percent) * (1 + scanned))
        if cost < best:
            best, at = cost, n
    return at


def light_pairs(reps: DataFrame, most: int, percent: int) -> DataFrame:
    """Pairs that tie all sets of up to ``most`` members together that share a subset.

    Within the sizes n < m, every set of one size links with every one of the other that has
    the key, so the least id of either side stands for its side.
    """

    def run(frames):
        for frame in frames:
            ids, keys, sides = [], [], []
            for i, n, tokens in zip(frame["id"], frame["n"], frame["tokens"]):
                members = np.asarray(tokens, np.int64).view(np.uint64)
                total = members.sum(dtype=np.uint64)
                for m in partner_sizes(n, percent):
                    keep = least_overlap(n, m, percent)
                    if keep > n or max(n, m) > most:
                        continue
                    if keep == n:
                        sums = np.array([total], np.uint64)
                    else:
                        left_out = np.array(list(combinations(range(n), n - keep)))
                        sums = total - members[left_out].sum(1, dtype=np.uint64)
                    found = lists.subset_key(min(n, m), max(n, m), sums)
                    keys.append(found)
                    ids.append(np.full(len(found), i))
                    sides.append(np.full(len(found), int(n > m) if n != m else 2))
            yield pd.DataFrame({"key": np.concatenate(keys), "id": np.concatenate(ids),
                                "side": np.concatenate(sides)} if keys else
                               {"key": [], "id": [], "side": []}).astype("int64")

    rows = cut(reps.where(F.col("n") <= most).select("id", "n", "tokens")
               .mapInPandas(run, "key long, id long, side long"))
    least = rows.groupBy("key").agg(*[F.min(F.when(F.col("side") == s, F.col("id"))).alias(f"m{s}")
                                      for s in range(3)])
    other = F.when(F.col("side") == 0, F.col("m1")).when(F.col("side") == 1, F.col("m0")).otherwise(
        F.col("m2"))
    return (rows.join(least, "key").select("id", other.alias("o")).where("o is not null and o <> id")
            .select(F.least("id", "o").alias("a"), F.greatest("id", "o").alias("b")).distinct())


def join_sets(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS,
              percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) of every row: the smallest id its links reach."""
    texts = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    common = lists.common_shingles(texts, words, percent)
    packed = cut(lists.packed_sets(texts, words, percent, common))
    reps = cut(lists.representatives(packed))
    listed = cut(lists.shared_lists(reps, percent))

    small = reps.where(F.col("n") <= lists.SMALL).groupBy("n").count().collect()
    means = listed.agg(F.avg("len")).first()[0]
    most = boundary({r["n"]: r["count"] for r in small}, means or 0.0, percent)

    heavy = listed.where(F.col("n") * 100 >= F.lit(percent * (most + 1)))
    star = lists.plausible(lists.star_pairs(heavy).unionByName(light_pairs(reps, most, percent))
                           .distinct(), reps, percent)
    links = cut(verify(star, texts, words, percent))
    grouped = cut(components(links))
    rows = cut(lists.mixed_rows(heavy, grouped))
    short = lists.across_pairs(rows.where(F.col("len") <= lists.LONG), percent, most)
    links = links.unionByName(cut(verify(lists.plausible(short, reps, percent), texts, words, percent)))
    unsettled = cut(rows.where(F.col("len") > lists.LONG).select("id").distinct())
    if not unsettled.isEmpty():
        links = links.unionByName(cut(lists.links_across(
            involved(texts, unsettled), texts, grouped, words, percent)))
    twins = (packed.where("cls is not null and id is not null").select("cls", F.col("id").alias("b"))
             .join(reps.select("cls", F.col("id").alias("a")), "cls").where("a <> b")
             .select("a", "b").distinct())
    final = components(links.unionByName(twins))
    return (packed.select("id", F.col("n").alias("n_shingles")).join(final, "id", "left")
            .select("id", "n_shingles", F.coalesce("component", "id").alias("component_id")))
