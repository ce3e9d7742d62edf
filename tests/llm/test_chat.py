import hashlib

from pyspark.sql import functions as F

from tessera.llm import chat

TURNS = "conv_id long, turn long, role string, text string, formatted string, segments int"
ROWS = [
    (1, 0, "user", "hi", "x", 1), (1, 1, "user", "again", "x", 1), (1, 2, "assistant", "yes\n<|end|>", "x", 1),
    (2, 5, "assistant", None, "x", 1), (2, 3, "system", "", "x", 1), (2, None, "user", "first", "x", 1),
    (3, 0, None, "\\<|start|>\\\\</s>\\", "x", 1), (3, 0, None, "\\<|start|>\\\\</s>\\", "x", 1),
    (3, 1, "assistant", "<|start|>user\n<|text|>", "x", 1), (3, 1, "assistant", "[INST][/INST]<<SYS>>é😀", "x", 1),
    (None, 0, "us<|text|>er", "null id", "x", 1), (4, 0, "assistant", "long " * 50000, "x", 1),
]


def test_round_trip_and_mask(spark):
    made = chat.format_chats(spark.createDataFrame(ROWS, TURNS).repartition(3))
    got = {r["conv_id"]: r for r in made.select(
        "conv_id", "formatted", "segments", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_texts(F.col("segments")).alias("loss")).collect()}
    by_conv = {}
    for c, n, role, text, *_ in ROWS:
        by_conv.setdefault(c, []).append(((n is not None, n), role or "", text or ""))
    assert set(got) == set(by_conv)
    for conv, turns in by_conv.items():
        want = [t[1:] for t in sorted(turns, key=lambda t: (t[0][0], t[0][1] or 0, t[1], t[2]))]
        assert [tuple(t) for t in got[conv]["turns"]] == want
        assert got[conv]["loss"] == [x for r, x in want if r == "assistant"]
        assert "".join(s["text"] for s in got[conv]["segments"]) == got[conv]["formatted"]


def test_adjacent_turns_of_a_role_share_a_block(spark):
    text = chat.format_chats(spark.createDataFrame(ROWS[:3], TURNS)).first()["formatted"]
    assert text.count("\n" + chat.START) == 2 and text.count("\n" + chat.NEXT) == 1


def test_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], TURNS)).count() == 0


def test_query_reads_back_the_probe(spark):
    from tessera.llm.queries import QUERIES
    row = QUERIES["op1_chat_format"](spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    probe = "</s>[INST] ok [/INST]"
    whole = f"user\n{probe}\nassistant\n{probe}\n".encode()
    assert row["n_turns"] == 2 and row["turns_sha256"] == hashlib.sha256(whole).hexdigest()
    assert row["loss_chars"] == len(probe) and row["loss_sha256"] == hashlib.sha256(probe.encode()).hexdigest()
