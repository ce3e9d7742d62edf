import random

import numpy as np
import pytest
from conftest import SCHEMA, words
from pyspark.sql import functions as F

from tessera.llm import near_dup as nd
from tessera.llm import shingles


def brute(rows):
    """component and set size per row, for rows with an id."""
    sets = [(i, nd.shingle_set(nd.words_of(t))) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1:]:
            if nd.linked(x, y):
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


def found(df):
    rows = nd.near_duplicates(df).collect()
    assert all(r["component_id"] is None and r["kept"] for r in rows if r["id"] is None)
    return sorted((r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows if r["id"] is not None)


def test_corpus(docs):
    extra = docs.withColumns({"id": F.lit("clash"), "cls": F.lit(1), "keys": F.lit(2)})
    assert found(extra) == brute(docs.collect())


def test_chains_of_edits_keep_every_link(spark):
    rng = random.Random(5)
    rows = []
    for g in range(4):
        text = words(rng, 150).split()
        for i in range(40):
            rows.append((1000 * g + i, " ".join(text), None, None, 0))
            text = list(text)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = words(rng, 1)
    rng.shuffle(rows)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(6)) == brute(rows)


def template_family(pairs, extra, private_words, template_words=170, seed=3):
    """Documents of one template; two of each pair share further words and link, no others do."""
    rng = random.Random(seed)
    template = [f"t{i}" for i in range(template_words)]
    rows = []
    for p in range(pairs):
        both = [f"p{p}x{i}" for i in range(extra)]
        for s in range(2):
            own = [f"q{p}s{s}x{i}" for i in range(private_words)]
            rows.append((2 * p + s, " ".join(template + both + own), None, None, 0))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("extra, private_words", [(1, 14), (12, 15)])
def test_links_within_a_template_family(spark, extra, private_words):
    """Partners are 0.856 alike; others of the family 0.847, or 0.755."""
    rows = template_family(200, extra, private_words)
    truth = brute(rows)
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert got == truth
    assert sum(not kept for *_, kept in truth) == 200


def test_template_family_brings_few_candidates(spark, monkeypatch):
    """What is compared across components grows with the family, not with its square."""
    counted = []
    plain = nd.prefix_lists.across_pairs

    def counting(*args, **kwargs):
        pairs = plain(*args, **kwargs)
        counted.append(pairs.count())
        return pairs
    monkeypatch.setattr(nd.prefix_lists, "across_pairs", counting)
    rows = template_family(700, 1, 14)
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(8))
    assert sum(not kept for *_, kept in got) == 700
    assert sum(counted) <= 3 * len(rows)


def test_empty(none):
    assert found(none) == []


def test_vector_sets_match_the_plain_ones():
    rng = random.Random(8)
    texts = [words(rng, n) for n in (0, 1, 4, 5, 6, 50)] + ["A b\tC\x0bd\ne f", "x " * 40, "", " é É ", "\x85a b"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    _, at = shingles.hashed_sets(np.frombuffer(b"".join(raw), np.uint8), offsets, nd.SHINGLE_WORDS)
    assert np.diff(at).tolist() == [len(nd.shingle_set(nd.words_of(t))) for t in texts]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[1000:]
    reg = lambda *sets: nd.registers_of(np.concatenate(sets), np.concatenate(
        ([0], np.cumsum([len(s) for s in sets]))))
    ra, rb = reg(a, b)
    assert (nd.merge(ra, rb) == reg(pool)[0]).all()
    j = nd.likeliest_jaccard(ra[None], rb[None], np.array([2000.0]), np.array([2000.0]))[0]
    assert j == pytest.approx(1 / 3, abs=0.13)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7)] + [(300, 301 + i) for i in range(90)]
    got = dict(map(tuple, nd.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(61)) and got[150] == got[200] == 100
    assert all(got[301 + i] == 300 for i in range(90))
