import random

import pytest

sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")

from tessera.llm import q_tokens, tokens  # noqa: E402

BITS = ["a", "b", "th", "e", " ", "  ", "\n", "▁", "é", "梦", "\t", "\x00", "ing", "!", "中", "😀", "x", " the",
        "<s>", "</s>", "<0x0A>", "0", "12", ".", "　", "tion", "ll", "ᾳ"]


@pytest.fixture(scope="module")
def model():
    return q_tokens.model_bytes()


def random_text(rng, n):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, n)))


def test_counts_equal_the_library(model):
    sp, machine, rng = sentencepiece.SentencePieceProcessor(model_proto=model), tokens.Transducer(model), random.Random(1)
    for _ in range(4000):
        t = random_text(rng, 40)
        assert machine.count(t) == len(sp.encode(t)), repr(t)
    for k in (0, 1, 15, 16, 17, 31, 100, 1000):
        for t in (" " * k, " " * k + "the", "the" + " " * k, "a" * k, "\n" * k):
            assert machine.count(t) == len(sp.encode(t)), repr(t)


def test_chunk_maps_compose_at_any_cut(model):
    machine, rng = tokens.Transducer(model), random.Random(2)
    for _ in range(800):
        t = random_text(rng, 60) or "x"
        cuts = sorted(rng.randint(0, len(t)) for _ in range(rng.randint(0, 8)))
        parts = [t[a:b] for a, b in zip([0, *cuts], [*cuts, len(t)])]
        assert machine.finish([machine.chunk(p) for p in parts]) == machine.count(t), repr(t)


def test_small_tables_give_the_same(model, monkeypatch):
    monkeypatch.setattr(tokens, "WORDS_KEPT", 20)
    monkeypatch.setattr(tokens, "STATES_KEPT", 30)
    sp, machine, rng = sentencepiece.SentencePieceProcessor(model_proto=model), tokens.Transducer(model), random.Random(3)
    for _ in range(200):
        t = random_text(rng, 40)
        assert machine.count(t) == len(sp.encode(t))


@pytest.mark.parametrize("long", [tokens.LONG, 500])
def test_rows(docs, none, model, long):
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    got = tokens.count_tokens(docs, model, long=long, chunk=97).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(sp.encode(r["text"] or ""))) for r in docs.collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert tokens.count_tokens(none, model).count() == 0
