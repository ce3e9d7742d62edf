import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import q_sharding, sharding


def plain_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_matches_the_plain_loop():
    keys = np.random.default_rng(3).integers(0, 1 << 63, 2000).astype(np.uint64) * np.uint64(2)
    for shards in (1, 2, 16, 17, 1000):
        assert sharding.jump(keys, shards).tolist() == [plain_jump(int(k), shards) for k in keys]


def test_only_new_shards_receive_rows():
    keys = np.arange(100_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = sharding.jump(keys, 16), sharding.jump(keys, 17)
    moved = a != b
    assert set(b[moved]) == {16}
    assert abs(moved.mean() - 1 / 17) < 0.005
    assert np.bincount(a).min() > 5800


def test_slots_are_gapless_and_repeatable(docs):
    def rows(d):
        return sorted(map(tuple, q_sharding.assigned(d).collect()), key=repr)
    got = rows(docs)
    assert got == rows(docs.repartition(2))
    columns = q_sharding.assigned(docs).columns
    table = [dict(zip(columns, r)) for r in got]
    assert len(table) == docs.count()
    for s in {r["shard"] for r in table}:
        slots = sorted(r["slot"] for r in table if r["shard"] == s)
        assert slots == list(range(len(slots)))
    texts = {(r["doc_id"], zlib.crc32((r["text"] or "").encode()), len((r["text"] or "").encode()) + 1)
             for r in docs.collect()}
    assert {(r["doc_id"], r["text_crc32"], r["size"]) for r in table} == texts
    assert all(r["grown_shard"] in (r["shard"], 16) for r in table)


def test_many_buckets_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 50)
    rows = spark.range(3000).select(F.col("id"), sharding.shard_of(F.col("id"), 3).alias("shard"),
                                    F.lit(1).alias("n"), F.lit(2).alias("base"))
    out = sharding.slots(rows, "shard", ["id"]).toPandas()
    for _, part in out.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    assert set(out.columns) == {"id", "shard", "n", "base", "slot"}


def test_empty(none):
    assert q_sharding.assigned(none).count() == 0
