import hashlib
import random

import numpy as np
import pytest
from conftest import words
from pyspark.sql import functions as F

from tessera.llm import fingerprint as fp


def plain_phrases(text):
    known, current = set(), ""
    for c in text:
        current += c
        if current not in known:
            known.add(current)
            current = ""
    return known


def test_parse_finds_the_lz78_phrases():
    rng = random.Random(3)
    for text in ("", "a", "abababab", words(rng, 300), "é梦" * 40):
        assert len(fp.Parse().feed(text).phrases) == len(plain_phrases(text))


def test_dictionary_restarts_but_reads_on(monkeypatch):
    rng = random.Random(4)
    text = words(rng, 3000)
    monkeypatch.setattr(fp, "PHRASES", 50)
    whole = fp.fingerprint(text)
    assert whole == fp.fingerprint(text) and whole != fp.fingerprint(text[:-4000])
    assert len(fp.Parse().feed(text).phrases) < 50


def test_parse_does_not_depend_on_how_a_text_is_fed(monkeypatch):
    rng = random.Random(6)
    text = words(rng, 2000)
    monkeypatch.setattr(fp, "PHRASES", 70)
    whole = fp.fingerprint(text)
    for _ in range(20):
        parse, at = fp.Parse(), 0
        while at < len(text):
            n = rng.choice([1, 7, 69, 70, 71, 1000, len(text)])
            parse.feed(text[at:at + n])
            at += n
        assert fp.to_hex(parse.smallest()) == whole
        head = fp.Parse().feed(text[:at // 2])
        assert fp.to_hex(head.copy().feed(text[at // 2:]).smallest()) == whole


def brute(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for n, (i, t) in enumerate(order):
        t, nxt = t or "", order[(n + 1) % len(order)][1] or ""
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        a, e, b = (fp.from_hex(fp.fingerprint(x)) for x in (t, edited, nxt))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), fp.to_hex(a), fp.to_hex(e),
                    fp.likeness(a, e), fp.likeness(a, b)))
    return sorted(out)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_next_document_and_edit(spark, ranges):
    rng = random.Random(9)
    rows = [(i * 3, words(rng, rng.randint(0, 60))) for i in range(70)] + [
        (500, None), (501, ""), (502, "é梦😀x"), (-5, words(rng, 8000))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumns(
        {"id": F.lit("clash"), "range": F.lit(1), "tail": F.lit(2)})
    assert sorted(map(tuple, fp.compare_with_next(df, ranges=ranges).collect())) == brute(rows)


def test_one_row_follows_itself_and_repeats_agree(spark):
    one = spark.createDataFrame([(1, "abc def")], "doc_id long, text string")
    assert [tuple(r) for r in fp.compare_with_next(one).collect()] == brute([(1, "abc def")])
    many = spark.createDataFrame([(1, "same text"), (1, "same text"), (1, "other"), (None, "x"), (None, None)],
                                 "doc_id long, text string")
    rows = fp.compare_with_next(many, ranges=3).collect()
    assert sorted(r["doc_id"] or 0 for r in rows) == [0, 0, 1, 1, 1]
    same = [r["fingerprint"] for r in rows if r["n_chars"] == 9]
    assert same[0] == same[1]


def test_empty(none):
    assert fp.compare_with_next(none).count() == 0


def test_likeness():
    a = np.arange(64, dtype=np.uint32)
    assert fp.likeness(a, a) == 1 and fp.likeness(a, a + 1000) == 0
    assert fp.likeness(a[:0], a[:0]) == 1 and fp.likeness(a, a[:0]) == 0
