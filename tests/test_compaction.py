"""In-place merging of small files: names, rows, odd partition values, crashes."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.session import work_path
from tessera.sinks import compaction as C

SMALL = 20_000


def _folder(spark):
    path = work_path(spark, "to_merge")
    k = F.col("id") % 3
    part = F.when(k == 1, F.lit("a b%c=d")).when(k == 2, F.lit("01"))
    few = spark.range(2000).select("id", part.alias("k"))
    few.repartition(12).write.partitionBy("k").parquet(path)
    large = spark.range(5000, 105000).select("id", F.lit("01").alias("k")).coalesce(1)
    large.write.mode("append").partitionBy("k").parquet(path)
    return path


def _files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs
            if f.endswith(".parquet")}


def _rows(spark, path):
    return sorted((r["id"], str(r["k"])) for r in spark.read.parquet(path).collect())


def test_only_small_files_are_replaced(spark):
    path = _folder(spark)
    before, rows = _files(path), _rows(spark, path)
    replaced = C.merge_small_files(spark, path, SMALL, 1 << 20)
    after = _files(path)
    kept = {f for f, size in before.items() if size >= SMALL}
    assert len(kept) == 1 and kept <= set(after)
    assert not (set(before) - kept) & set(after) and replaced == len(before) - 1
    assert len(after) == 1 + 3 and {os.path.dirname(f) for f in after} == {os.path.dirname(f) for f in before}
    assert _rows(spark, path) == rows
    assert C.merge_small_files(spark, path, SMALL, 1 << 20) == 0 and _files(path) == after


def test_bins_are_bounded(spark):
    path = _folder(spark)
    target = 2000
    bins = C.small_file_bins(spark, path, SMALL, target).groupBy("_compact_folder", "_compact_bin").agg(
        F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()
    assert len(bins) > 3 and all(r["b"] < target + SMALL and r["n"] > 1 for r in bins)
    rows = _rows(spark, path)
    C.merge_small_files(spark, path, SMALL, target)
    assert _rows(spark, path) == rows


@pytest.mark.parametrize("moved", [0, 1])
def test_a_crash_is_finished_or_undone(spark, monkeypatch, moved):
    path = _folder(spark)
    before, rows = _files(path), _rows(spark, path)
    real = C.finish
    calls = []

    def crash(s, p):
        calls.append(p)
        if len(calls) > 1:
            raise KeyboardInterrupt
        return real(s, p)

    monkeypatch.setattr(C, "finish", crash)
    with pytest.raises(KeyboardInterrupt):
        C.merge_small_files(spark, path, SMALL, 1 << 20)
    monkeypatch.setattr(C, "finish", real)
    stage = next(os.path.join(path, d) for d in os.listdir(path) if d.startswith(C.STAGE))
    assert _rows(spark, path) == rows  # a stage is no data
    if moved:  # some files have moved already
        source, target = spark.read.parquet(f"{stage}/moves").first()
        store, at = C._store(spark, path)
        assert store.rename(at(source, True), at(target, True))
        assert C.finish(spark, path) == len(before) - 1
    else:  # the lists are not whole: the stage goes, the files stay
        os.remove(f"{stage}/{C.REPLACED}")
        assert C.finish(spark, path) == 0 and _files(path) == before
    assert _rows(spark, path) == rows and not any(d.startswith(C.STAGE) for d in os.listdir(path))


def test_files_of_different_columns(spark):
    path = work_path(spark, "columns")
    spark.range(3).coalesce(1).write.parquet(path)
    spark.range(3, 6).withColumn("extra", F.lit("x")).coalesce(1).write.mode("append").parquet(path)
    assert C.merge_small_files(spark, path, SMALL) == 2
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("id", "extra").collect())
    assert got == [(i, None if i < 3 else "x") for i in range(6)]


def test_empty_folder(spark):
    path = work_path(spark, "empty")
    spark.range(0).write.parquet(path)
    C.merge_small_files(spark, path, SMALL)
    assert spark.read.parquet(path).count() == 0


def test_a_file_left_over_is_merged_as_well(spark):
    path = work_path(spark, "left_over")
    for n in range(1, 6):
        spark.range(n, n + 1).coalesce(1).write.mode("append").parquet(path)
    sizes = _files(path).values()
    # four files reach the target, the fifth begins a bin of its own
    assert C.merge_small_files(spark, path, max(sizes) + 1, 4 * min(sizes)) == 5
    assert len(_files(path)) == 2
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(1, 6))


def test_query_has_more_writers_for_more_rows(spark, tmp_path, monkeypatch):
    """Several large files a folder, so several bins of small ones, and all of these are merged."""
    from tessera.queries import physical_queries as PQ
    spark.range(60000).selectExpr("id AS l_orderkey", "IF(id % 4 < 2, 'N', 'A') AS l_returnflag",
                                  "CAST(id % 50 AS DOUBLE) AS l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    large = []
    merge = C.merge_small_files

    def seen(session, path, small, target):
        large.extend(f for f, size in _files(path).items() if size >= small)
        return merge(session, path, small, target)

    monkeypatch.setattr(PQ.C, "merge_small_files", seen)
    monkeypatch.setattr(PQ, "MERGE_ROWS", 20000, raising=False)
    rows = PQ.merge_small_files(spark, str(tmp_path)).collect()
    assert [r["lines"] for r in rows] == [30000, 30000]
    assert all(r["large_files_kept"] and r["small_files_merged"] for r in rows)
    assert len(large) == 6
