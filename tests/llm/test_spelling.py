import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SCHEMA
from pyspark.sql import functions as F

from tessera.llm import spelling
from tessera.llm.q_spelling import op11_spelling_variants


def one_edit(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(u) + 1 == len(v) and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def plain_vocabulary(rows):
    total = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 199 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def plain_variants(vocab):
    near = {w: [x for x in vocab if x != w and one_edit(w, x)] for w in vocab}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-vocab[x], x))
            if vocab[best] >= 5 * vocab[w]:
                form[w] = best
    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), n, len(near[w]), vocab[form[w]] if w in form else None)
                  for w, n in vocab.items())


def test_pairs_of_small_alphabets():
    rng = random.Random(2)
    for _ in range(60):
        words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(0, 6))) for _ in range(40)})
        got = spelling.one_edit_pairs(words)
        assert {frozenset(p) for p in got} == {frozenset((u, v)) for u in words for v in words
                                               if u < v and one_edit(u, v)}
        assert all(len(u) < len(v) or u < v for u, v in got)


def test_acceptor_is_minimal():
    words = sorted(a + b for a in ("", "a", "ab", "xyz") for b in ("end", "ends"))
    machine = spelling.Acceptor(words)
    seen, waiting = set(), [0]
    while waiting:
        s = waiting.pop()
        if s not in seen:
            seen.add(s)
            waiting += machine.arcs[s].values()
    rights = set()
    def right(s):
        return frozenset((["" if machine.final[s] else None]) + [a + r for a, t in machine.arcs[s].items()
                                                                 for r in right(t) if r is not None])
    rights = {right(s) for s in seen}
    assert len(rights) == len(seen)


@pytest.mark.parametrize("most", [20_000, 3])
def test_variants_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(spelling, "MOST_WORDS", most)
    rng = random.Random(3)
    vocab = {}
    for size in (6, 7, 8, 9, 12, 13):
        base = "".join(rng.choice("abcé") for _ in range(size))
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(w))
                w[at:at + 1] = rng.choice([[], [rng.choice("abcéß")], [w[at], rng.choice("ab")]])
            if len(w) >= 6:
                vocab["".join(w)] = rng.choice([5, 5, 6, 30, 31, 200, 1500])
    vocab["long" * 800] = 7
    vocab["long" * 800 + "s"] = 70
    words = spark.createDataFrame(list(vocab.items()), "word string, n long").repartition(4)
    got = spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got)) == plain_variants(vocab)


def texts():
    rng = random.Random(4)
    base = ["Wonder", "wonders", "wondered", "straße", "strasse", "naïvely", "Naively", "ÀBCDEFG", "abcdefg",
            "short", "letters", "lettres", "letter×s", "colour", "color", "colours"]
    rows = [(i, " ".join(rng.choices(base, [9, 2, 1] * 5 + [3], k=rng.randint(0, 90))) + rng.choice(["", ".", "1x", "\n😀"]),
             "en", "s", 1) for i in range(400)]
    return rows + [(None, "wonder " * 9, None, None, None), (900, None, "en", "s", 1), (901, "", "en", "s", 0),
                   (902, "wonder" * 3000 + " letters", "en", "s", 1), rows[3], rows[3]]


def test_query_equals_brute_force(spark, tmp_path):
    rows = texts()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"word": F.lit(1), "n": F.lit("x"), "id": F.lit(2), "m": F.lit(3)})
    df.repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_spelling_variants(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    truth = plain_variants(plain_vocabulary(rows))
    assert sorted(map(tuple, got.collect())) == truth
    assert any(form for _, form, *_ in truth)


def test_flushed_counts_add_up(spark, monkeypatch, docs):
    whole = sorted(map(tuple, spelling.vocabulary(docs, min_count=1).collect()))
    monkeypatch.setattr(spelling, "HELD_WORDS", 40)
    assert whole and sorted(map(tuple, spelling.vocabulary(docs, min_count=1).collect())) == whole


def test_empty(spark, none):
    assert spelling.variants(spelling.vocabulary(none)).collect() == []
