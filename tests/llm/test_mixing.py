import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tessera.llm import mixing
from tessera.llm.common import word_count


def mixed(docs, **kw):
    return mixing.mix(docs, word_count(F.col("text")), F.lit(1.0), mixing.text_tie(), **kw)


def brute_targets(sizes, cycle=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: cycle[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 2.0 * sizes[s] for s in over}


def test_targets_and_amounts(docs):
    rows = mixed(docs).collect()
    again = mixed(docs.repartition(2)).collect()
    assert Counter(rows) == Counter(again)
    assert len(rows) == docs.count()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["times"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert 0 <= r["times"] <= 2
    want = brute_targets(sizes)
    for r in rows:
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
        assert r["source_size"] == sizes[r["source"]]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_complete_passes_come_before_the_fraction(docs):
    for r in mixed(docs).collect():
        if r["size"]:
            assert r["times"] >= math.floor(r["target"] / r["source_size"] + 1e-9)


def test_quality_raises_the_chance(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"),
        F.when(F.col("id") % 4 < 2, 4.0).otherwise(1.0).alias("quality"))
    rows = mixing.mix(docs, word_count(F.col("text")), F.col("quality"), mixing.text_tie(),
                      share=0.4).collect()
    good = sum(r["times"] for r in rows if r["id"] % 4 < 2)
    assert good > 1.5 * sum(r["times"] for r in rows if r["id"] % 4 >= 2)


def test_repeat_keeps_columns_and_amounts(docs):
    plan = mixed(docs)
    extra = docs.withColumn("tie", F.lit("clash")).withColumn("times", F.lit(9))
    out = mixing.repeat(extra, plan)
    assert out.columns == extra.columns
    assert out.count() == sum(r["times"] for r in plan.collect())


def test_empty_and_wordless(spark, none):
    assert mixed(none).count() == 0
    blank = spark.createDataFrame([(1, None, None, "a", 0), (2, "", None, None, 0)], none.schema)
    rows = mixed(blank).collect()
    assert [(r["size"], r["target"]) for r in rows] == [(0, 0.0), (0, 0.0)]
