import random

import pytest

from tessera.llm import language

SOUNDS = {"aa": "ka ta mo li ru pe na so".split(), "bb": "sch ung ein ver ach lich ge keit".split()}
SCHEMA = "doc_id long, text string, lang string, pred int, lang_other string"


def text(lang, rng, n=40):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    rows = [(i, text(lang, rng, rng.randint(4, 90)), lang, 1, "x") for i in range(150) for lang in SOUNDS]
    rows += [(1000, None, "aa", 1, "x"), (1001, "", "aa", 1, "x"), (1002, "12 .. 34", "bb", 1, "x"),
             (1003, text("bb", rng, 60000), None, 1, "x"), (None, text("aa", rng), "aa", 1, "x"),
             (1004, "Ünicode 梦", None, 1, "x"), (1004, "Ünicode 梦", None, 1, "x")]
    return spark.createDataFrame(rows, SCHEMA)


def test_held_out_accuracy(table):
    learned = language.learn_dictionaries(table.where(~language.held_out()))
    assert sorted(learned) == ["aa", "bb"]
    rows = language.identify(table.where(language.held_out()), learned).collect()
    known = [r for r in rows if r["lang"] and r["text"] and any(map(str.isalpha, r["text"]))]
    assert len(known) > 30 and all(r["lang_pred"] == r["lang"] for r in known)
    assert all(0 <= r["lang_score"] <= 1 for r in rows)


def test_letterless_is_undetermined_and_rejected(table):
    learned = language.learn_dictionaries(table)
    rows = {r["doc_id"]: r for r in language.identify(table, learned).collect()}
    for i in (1000, 1001, 1002):
        assert rows[i]["lang_pred"] == "und" and rows[i]["lang_score"] == 0 and rows[i]["lang_rejected"]
    assert rows[1003]["lang_pred"] == "bb" and not rows[1003]["lang_rejected"]
    assert rows[1004]["lang_pred"] in SOUNDS
    assert set(SCHEMA.replace(",", "").split()[::2]) < set(language.identify(table, learned).columns)


def test_sample_does_not_depend_on_layout(table):
    assert language.learn_dictionaries(table) == language.learn_dictionaries(table.repartition(7))


def test_dictionary_is_bounded(table):
    learned = language.learn_dictionaries(table, dict_bytes=500)
    assert all(len(d) <= 500 for d in learned.values())


def test_nothing_learned(table):
    learned = language.learn_dictionaries(table.limit(0))
    assert learned == {}
    assert {r["lang_pred"] for r in language.identify(table, learned).collect()} == {"und"}
    some = language.learn_dictionaries(table)
    assert language.identify(table.limit(0), some).count() == 0
