import random
import re

from clickweir.llm import chat

BITS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>", "<<TEXT>>", "\\", "<", "[", "s>", "/s>", "INST]", ">",
        "]", "a", " ", "\n", "é", "$1", "<\\s>", "[\\\\INST]", "\U0001f600"]
SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def hostile(count):
    pick = random.Random(3)
    return [(c, t, pick.choice(["user", "assistant", "system", "tool", None, "", "<s>", "a<<TEXT>>b"]),
             pick.choice([None, ""]) if pick.random() < 0.05 else "".join(pick.choices(BITS, k=pick.randrange(0, 8))), "clash")
            for c in range(count) for t in range(pick.randrange(1, 5))]


def plain(text):
    return re.sub(r"([<\[])\\(\\*)(/?s>|/?INST\]|</?SYS>>|</?ROLE>>|<TEXT>>)", r"\1\2\3", text)


def test_round_trip_of_hostile_texts(spark):
    rows = hostile(800)
    chats = chat.formatted(spark.createDataFrame(rows, SCHEMA))
    back = {r["conv_id"]: r for r in chat.read_back(chats).collect()}
    source = {}
    for c, _, role, text, _ in rows:
        source.setdefault(c, []).append((role or "", text or ""))
    for r in chats.collect():
        turns = source[r["conv_id"]]
        assert r["round_trip"] and r["n_turns"] == len(turns)
        assert [tuple(t) for t in back[r["conv_id"]]["turns"]] == turns
        said = "".join(t for role, t in turns if role == "assistant")
        assert "".join(plain(r["formatted"][s["start"]:s["end"]]) for s in r["loss_spans"]) == said == back[r["conv_id"]]["loss_text"]


def test_only_conflicts_are_escaped(spark):
    rows = [(1, 0, "user", "see <b> [x] and \\ <s>", ""), (1, 1, "assistant", "</s>[INST] ok", "")]
    (r,) = chat.formatted(spark.createDataFrame(rows, SCHEMA)).collect()
    assert r["formatted"] == "[INST]see <b> [x] and \\ <s>[/INST]<s><\\/s>[\\INST] ok</s>"


def test_order_ties_and_nulls(spark):
    rows = [(None, 1, "user", "b", ""), (None, 1, "user", "a", ""), (None, None, "assistant", "z" * 100_000, ""), (7, 5, None, None, ""), (7, 5, None, None, "")]
    got = {r["conv_id"]: r for r in chat.read_back(chat.formatted(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert [t["text"][:1] for t in got[None]["turns"]] == ["z", "a", "b"] and len(got[7]["turns"]) == 2
    assert got[7]["turns_text"] == "\n\n\n\n"
    assert chat.formatted(spark.createDataFrame([], SCHEMA)).count() == 0
