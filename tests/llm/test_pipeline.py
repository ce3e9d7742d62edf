import random

import corpus_pipeline as cp
import pytest
from conftest import SCHEMA, words
from pyspark.sql import functions as F

from tessera.llm import decontaminate, language, near_dup, sharding

FR = ("eau", "tion", "ent", "que", "les", "ou", "ai", "é", "vi", "pa")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(31)
    at = str(tmp_path_factory.mktemp("tables"))
    bench = [(i, words(rng, 40)) for i in range(5)]
    rows = []
    for i in range(160):
        lang = "fr" if i % 3 == 0 else "en"
        text = words(rng, rng.randint(20, 90), FR) if lang == "fr" else words(rng, rng.randint(20, 90))
        if i % 20 == 1:
            text = rows[0][1]
        if i % 20 == 2:
            text = text + " " + bench[i % 5][1]
        rows.append((i, text, lang, f"src{i % 4}", len(text)))
    rows += [(200, None, None, None, 0), (201, "", "en", "src1", 0), (202, "12 34", "fr", "src1", 5), rows[9], rows[9]]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(0, 160, 5)], "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{at}/labels.parquet")
    return at


def test_stages_follow_each_other(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    names = [n for n, _ in cp.STAGES]
    assert names == ["language_id", "near_dup", "decontaminate", "mix_sources", "shard"]
    scorer = language._Scorer(language.learn_dictionaries(docs.where(~language.held_out())))
    now = [r for r in docs.collect()]
    for name, stage in cp.STAGES[:3]:
        before = now
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        now = docs.collect()
        if name == "language_id":
            want = [r for r in before if scorer(r["text"])[1] >= language.MIN_MARGIN]
            assert sorted(now) == sorted(want) and len(want) > 150
        if name == "near_dup":
            sets = {r["doc_id"]: near_dup.shingle_set(near_dup.words_of(r["text"])) for r in before}
            kept = {r["doc_id"] for r in now}
            assert len(kept) == len(now)
            for i in sets:
                linked = [j for j in sets if near_dup.linked(sets[i], sets[j])]
                assert (i in kept) == (min(linked) == i)
        if name == "decontaminate":
            bad = {r["doc_id"] for r in before for b in bench
                   if decontaminate.fold(b["text"]) in decontaminate.fold(r["text"])}
            assert bad and {r["doc_id"] for r in now} == {r["doc_id"] for r in before} - bad
    mixed = cp.mix_sources(spark, docs, folder)
    assert mixed.columns == docs.columns
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    total, taken = (sum(len(r["text"].split()) for r in d.collect()) for d in (docs, mixed))
    assert abs(taken - 1.5 * total) < 4 * 90


def test_near_copies_from_80_to_85_percent_go(spark, folder):
    rng, rows, pairs = random.Random(32), [], []
    for i in range(0, 80, 2):
        # two words in place of others, far apart, take ten of the shingles of each side
        first = words(rng, 104 + i // 8).split()
        second = list(first)
        second[30], second[60] = "changed", "words"
        rows += [(i, " ".join(first), "en", "s", 0), (i + 1, " ".join(second), "en", "s", 0)]
        x, y = (near_dup.shingle_set(near_dup.words_of(r[1])) for r in rows[-2:])
        pairs.append(len(x & y) / len(x | y))
    assert all(0.80 <= p < 0.85 for p in pairs)
    kept = cp.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), folder).collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(0, 80, 2))


def test_run_gives_shards(spark, folder):
    rows = cp.run(spark, folder).collect()
    assert rows
    for s in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    keys = spark.createDataFrame([(r["doc_id"],) for r in rows], "d long").distinct()
    want = dict(map(tuple, keys.select("d", sharding.shard_of(F.col("d"), 16)).collect()))
    assert all(want[r["doc_id"]] == r["shard"] for r in rows)


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_near_duplicate_stage_takes_any_further_columns(spark):
    rows = [(1, "a b c d e f g"), (2, "A b c d e f g"), (3, "other words of another text"), (3, "other words of another text")]
    docs = (spark.createDataFrame(rows, "doc_id long, text string")
            .selectExpr("*", "doc_id + 10 as _id", "'x' as id", "1 as n_shingles", "true as kept"))
    out = cp.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3]
