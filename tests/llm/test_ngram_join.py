import random

import numpy as np
import pytest
from conftest import SCHEMA, words
from pyspark.sql import functions as F

from tessera.llm import ngram_join, prefix_lists, shingles


def brute(rows, size=4, percent=85):
    sets = [(i, shingles.shingle_set(shingles.words_of(t), size)) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1:]:
            if shingles.linked(x, y, percent):
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return sorted((i, len(s), root(i)) for i, s in sets)


def found(df, **kwargs):
    rows = ngram_join.join_sets(df, **kwargs).collect()
    assert all(r["component_id"] is None for r in rows if r["id"] is None)
    return sorted(tuple(r) for r in rows if r["id"] is not None)


def families(rng):
    rows, i = [], 0
    for size in (4, 6, 9, 12, 16, 20, 24, 30, 40, 90, 250):
        base = words(rng, size).split()
        for _ in range(14):
            text = list(base)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(text))
                text[at:at + 1] = rng.choice([[], [words(rng, 1)], [words(rng, 1), words(rng, 1)]])
            rows.append((i, " ".join(text), None, None, 0))
            i += 1
    rng.shuffle(rows)
    return rows


def test_corpus(docs):
    extra = docs.withColumns({"id": F.lit("clash"), "n": F.lit(1), "token": F.lit(2), "cls": F.lit(3)})
    assert found(extra) == brute(docs.collect())


@pytest.mark.parametrize("percent, size", [(85, 4), (70, 2)])
def test_sizes_around_the_boundary(spark, percent, size):
    rows = families(random.Random(4))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, percent=percent, words=size) == brute(rows, size, percent)


@pytest.mark.parametrize("most", [0, 7, 20])
def test_any_boundary_gives_the_same(spark, monkeypatch, most):
    rows = families(random.Random(5))
    monkeypatch.setattr(ngram_join, "boundary", lambda *_: most)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_common_shingles_come_last_and_change_nothing(spark, monkeypatch):
    rng = random.Random(6)
    shared = words(rng, 60)
    rows = [(i, shared + " " + words(rng, rng.choice([4, 5, 9, 60])), None, None, 0) for i in range(120)]
    rows += [(500 + i, t + " more", None, None, 0) for i, (_, t, *_) in enumerate(rows[:30])]
    monkeypatch.setattr(prefix_lists, "COMMON", 5)
    monkeypatch.setattr(prefix_lists, "LONG", 10)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(df) == brute(rows)
    monkeypatch.setattr(prefix_lists, "MOST_COMMON", 10)
    assert found(df) == brute(rows)


def test_boundary_moves_with_the_cost():
    sizes = {n: 100 for n in range(1, 60)}
    assert ngram_join.boundary({}, 3.0, 85) == 0
    low, high = (ngram_join.boundary(sizes, s, 85) for s in (1.0, 50.0))
    assert 0 < low < high <= prefix_lists.SMALL
    assert ngram_join.subset_count(13, 85) == 13 + 13 + 1 + 1  # partners of 12 and 13, 14 and 15


def test_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2)
    for n, m, both in ((10, 12, 9), (300, 290, 280), (3000, 300, 300), (1500, 1600, 1450)):
        a, b = pool[:n], pool[n - both:n - both + m]
        x, y = shingles.parity_bitmaps(np.concatenate((a, b)), np.array([0, n, n + m]))
        assert shingles.least_difference(x, y) <= n + m - 2 * both
        assert shingles.least_difference(y, x) == shingles.least_difference(x, y)


def test_empty(none):
    assert found(none) == []
