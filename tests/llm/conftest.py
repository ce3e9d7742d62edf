import os
import random

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def importable(spark):
    """Python workers may start in another folder."""
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


def words(rng, n, syllables=("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha")):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(seed=7, n=60):
    """Small documents with copies, near copies, nulls, empties, ties and a long text."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(3, 200)) for _ in range(n)]
    shared = words(rng, 70)
    rows = []
    for i, text in enumerate(base):
        if i % 9 == 0:
            text = base[0]
        elif i % 9 == 1:
            parts = base[1].split()
            parts[rng.randrange(len(parts))] = "changed"
            text = " ".join(parts)
        elif i % 9 == 2:
            text = text + "\n" + shared + " " + words(rng, 9)
        rows.append((i, text, "en", f"src{i % 5}" if i % 7 else None, len(text)))
    rows += [(n, None, None, None, None), (n + 1, "", None, "src0", 0), (n + 2, " \t\n", "en", "src1", 3),
             (n + 3, "one two", "en", "src1", 7), (n + 4, "ONE\x0btwo", "en", "src1", 7),
             (n + 5, "é梦😀 " * 3, "en", "src2", 12), (n + 6, words(rng, 20000), "en", "src3", 9)]
    rows += [rows[3], rows[3], (None, base[5], "en", "src4", 1), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
