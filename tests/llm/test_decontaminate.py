import random

import numpy as np
from conftest import SCHEMA, words
from pyspark.sql import functions as F

from tessera.llm import decontaminate as dc

ITEMS = "item_id long, text string, doc_id string"


def bench_rows():
    rng = random.Random(21)
    return [(i, words(rng, 12 + 5 * i), "x") for i in range(8)] + [
        (8, words(rng, 40).upper(), "x"), (9, None, "x"), (10, "", "x"), (11, "short", "x"), (None, words(rng, 30), "x"),
        (12, "é梦ö " * 30, "x")]


def edit(rng, text, k):
    out = list(text)
    for _ in range(k):
        p = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[p] = "#"
        elif kind == 1:
            del out[p]
        else:
            out.insert(p, "%")
    return "".join(out)


def sellers(pattern, text):
    """Fewest edits between the pattern and any substring, the plain way."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern):
        new = [i + 1]
        for j, c in enumerate(text):
            new.append(min(row[j] + (p != c), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def brute(docs, items):
    index = dc.Windows([(i, t) for i, t, *_ in items if i is not None and t])
    out = set()
    for d, text, *_ in docs:
        folded = dc.fold(text)
        for w, pattern in enumerate(index.text):
            if d is not None and sellers(pattern, folded) <= index.budget[w]:
                out.add((d, index.item[w]))
    return out


def test_planted_passages(spark):
    rng, items = random.Random(22), bench_rows()
    rows = [(i, words(rng, rng.randint(1, 60)), None, None, 0) for i in range(30)]
    for n, (i, t, _) in enumerate(items[:9]):
        rows.append((100 + n, words(rng, 20) + " " + t + " " + words(rng, 9), None, None, 0))
        rows.append((200 + n, words(rng, 5) + edit(rng, t.lower(), len(t) // 40) + words(rng, 3), None, None, 0))
        rows.append((300 + n, t.replace(" ", "\n\t "), None, None, 0))
        rows.append((400 + n, edit(rng, t, len(t) // 5), None, None, 0))
    rows += [(500, None, None, None, 0), (501, "", None, None, 0), (None, items[3][1], None, None, 0),
             (502, "the the " * 90, None, None, 0), (503, "é梦ö " * 31, None, None, 0),
             (504, words(rng, 4000) + items[5][1], None, None, 0)]
    rows += [rows[31], rows[31]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items + [items[0]], ITEMS)
    found = dc.contaminated(docs, bench).collect()
    assert len({(r["doc_id"], r["item_id"]) for r in found}) == len(found)
    short = [r for r in rows if r[1] is None or len(r[1]) < 3000]
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert {x for x in got if x[0] != 504} == brute(short, items)
    assert (504, 5) in got
    assert {100 + n for n in range(9)} | {300 + n for n in range(9)} <= {d for d, _ in got}
    kept = dc.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in got} - {None}
    assert dc.clean(docs, bench, block_chars=300).count() == kept.count()
    blocks = dc.contaminated(docs, bench, block_chars=300).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, found))


def test_empty_tables(spark, none):
    bench = spark.createDataFrame(bench_rows(), ITEMS)
    assert dc.contaminated(none, bench).count() == 0
    assert dc.contaminated(none, bench.limit(0)).count() == 0


def test_banded_edits_agree_with_the_full_table():
    rng = random.Random(6)
    for _ in range(200):
        p = "".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))
        t = "".join(rng.choice("ab") for _ in range(rng.randint(0, 25)))
        # room on both sides, so that no path leaves the band
        room = "_" * len(p)
        assert dc.banded_edits(p, room + t + room, len(t) + 2 * len(p))[0] == sellers(p, t)


def test_bound_is_the_q_gram_lemma():
    for m in range(dc.Q, 101):
        assert dc.bound(m) == m - dc.Q + 1 - dc.Q * dc.budget(m) >= 1
    assert np.all(dc.Windows([(1, "x" * 100)]).bound >= 1)


def test_more_than_a_million_pairs_in_one_step():
    rng = random.Random(33)
    # the passage gives a pair a band, but too few q-grams for an alignment
    items = [(i, ("a common passage " + words(rng, 60))[:100].rstrip().ljust(100, "x")) for i in range(1100)]
    folded = [f"a common passage {i}" for i in range(1000)]
    for d in (0, 500, 999):
        folded[d] = items[d + 100][1]
    index = dc.Windows(items)
    assert len(index.text) * len(folded) > 1 << 20
    found = dc._matches(index, list(range(len(folded))), folded)
    assert set(zip(found["doc_id"], found["item_id"])) == {(0, 100), (500, 600), (999, 1099)}
    assert len(found) == 3


def test_windows_start_anywhere():
    rng = random.Random(34)
    items = [(i, words(rng, 80)[:300].strip()) for i in range(40)]
    folded = []
    for _, text in items:
        n = rng.randint(100, 140)
        at = rng.randint(0, len(text) - n)
        folded.append("zu " * rng.randint(0, 30) + text[at:at + n] + " zu" * rng.randint(0, 30))
    index, few = dc.Windows(items), dc.Windows(items[:2])
    found = dc._matches(index, list(range(40)), folded)
    assert {(i, i) for i in range(40)} <= set(zip(found["doc_id"], found["item_id"]))
    assert found[found["doc_id"] == found["item_id"]]["edits"].max() == 0
    # with edits, against the full table at every start
    folded = [edit(rng, items[i][1][30:150], k) for i in range(2) for k in (6, 60)]
    want = {}
    for d, text in enumerate(folded):
        for i, item in items[:2]:
            best = [sellers(item[w:w + 100], text) for w in range(len(item) - 99)]
            if min(best) <= 8:
                want[d, i] = (min(best), sum(e <= 8 for e in best))
    found = dc._matches(few, list(range(len(folded))), folded)
    assert {(d, i): (e, n) for d, i, e, n, _ in found.itertuples(index=False)} == want
    assert set(want) == {(0, 0), (2, 1)}


def test_clean_looks_for_items_without_an_id(spark):
    rng, unnamed = random.Random(35), bench_rows()[12][1]
    rows = [(1, words(rng, 20) + " " + unnamed, None, None, 0), (2, words(rng, 30), None, None, 0)]
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(bench_rows(), ITEMS)
    assert [r["doc_id"] for r in dc.clean(docs, bench).collect()] == [2]
    assert dc.contaminated(docs, bench).count() == 0
