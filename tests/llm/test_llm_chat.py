"""Chat layouts, the template and its way back, against plain Python."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from catalith.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def digest(turns):
    """Expected digests of one conversation given as (role, text)."""
    said = [t for r, t in turns if r == "assistant"]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), sum(map(len, said)), sha("".join(said))


def check(spark, rows, part=chat.PART):
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    got = {r.conv_id: r for r in chat.read(chat.formatted(df, part)).collect()}
    want = {}
    for c, _, r, t in sorted(rows, key=lambda x: (x[1] is not None, x[1], x[2] or "")):
        want.setdefault(c, []).append((r or "", t or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == digest(turns), c
    return got


NASTY = ["", None, " ", "</s>", "<s>", "[INST]", " [/INST]", "<\\s>", "<\\\\/s>", "[\\/INST]", "[ROLE]x[/ROLE]", "<<s>", "a</s", "[/INST", "<", "[", "\\", "\\\\", "</s>[INST] ok [/INST]", "$1 \\1", "é🙂</s>", "\n\t", "</s></s>", "[[INST]]"]


def test_round_trip(spark):
    rng = random.Random(2)
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "</s>", "[/ROLE]"]), "".join(rng.choice(NASTY) or "" for _ in range(rng.randrange(4))) or rng.choice(NASTY)))
    check(spark, rows)
    check(spark, rows, part=10)


def test_a_hot_conversation_spreads(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t} </s> " + "x" * (t % 50)) for t in range(3000)] + [(c, 0, "user", "hi") for c in range(2, 40)] + [(None, 1, "assistant", "b"), (None, 0, "user", None)]
    got = check(spark, rows, part=2000)
    assert got[1].n_turns == 3000
    parts = chat.formatted(spark.createDataFrame(rows, TURNS).repartition(5), 2000).where("conv_id = 1")
    assert parts.count() > 30 and parts.agg(F.max(F.length("text"))).first()[0] < 2200
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert parts.select(F.spark_partition_id()).distinct().count() > 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ties_and_repeated_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "assistant", "z"), (1, None, "user", "first")]
    got = check(spark, rows)
    assert got[1].n_turns == 4


def test_mask_covers_only_answers(spark):
    df = spark.createDataFrame([(1, 0, "user", "q</s>"), (1, 1, "assistant", "a</s>b"), (1, 2, "system", "s"), (1, 3, "assistant", "c")], TURNS)
    row = chat.formatted(df).collect()[0]
    assert [row.text[m.start : m.start + m.length] for m in row["mask"]] == ["a<\\/s>b", "c"]
    assert list(chat.parsed(row.text)) == [("user", "q</s>"), ("assistant", "a</s>b"), ("system", "s"), ("assistant", "c")]


RECORDS = [
    ({"messages": [{"role": "user", "content": "a", "extra": 1}, {"role": "assistant", "content": None}]}, "messages", [("user", "a"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "a"}, None, {"from": "gpt", "value": "b"}, {"from": "x", "value": 3}]}, "conversations", [("user", "a"), ("assistant", "b"), ("x", "3")]),
    ({"instruction": "do", "input": "it", "output": "done", "id": 3}, "instruction", [("user", "do\n\nit"), ("assistant", "done")]),
    ({"instruction": "do", "input": "", "output": "done", "system": ""}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "completion": "c"}, "prompt", [("user", "p"), ("assistant", "c")]),
    ({"system": "s", "prompt": "p", "response": "c"}, "response", [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ({"context": "k", "question": "q", "answer": "a"}, "question", [("user", "k\n\nq"), ("assistant", "a")]),
    ({"turns": [{"speaker": "bot", "text": "t"}]}, "turns", [("assistant", "t")]),
    ({"other": 1}, None, None),
    ([1], None, None),
]


def test_records_of_mixed_layouts(spark):
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)] + [(90, "{"), (91, None), (92, '{"prompt": "\\ud800", "completion": "c"}')]
    df = spark.createDataFrame([(i, r, "x") for i, r in rows], "conv_id long, record string, turns string")
    got = {r.conv_id: r for r in chat.records(df).collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert got[i].layout == layout
        assert (got[i].turns and [tuple(t) for t in got[i].turns]) == turns
    assert got[90].turns is None and got[91].turns is None and got[92].turns[0].text == "�"
    assert got[0].fingerprint == chat.fingerprint(["messages[].role", "messages[].content"])
    assert got[8].fingerprint is not None
    flat = chat.turns_of(chat.records(df)).where("conv_id = 1").orderBy("turn").collect()
    assert [(r.role, r.text) for r in flat] == RECORDS[1][2]


@pytest.mark.parametrize(
    ("schema", "row", "want"),
    [
        ("conv_id long, messages array<struct<role: string, content: string>>, noise int", (1, [("user", "a"), None, ("assistant", None)], 5), [("user", "a"), ("assistant", "")]),
        ("conv_id long, conversations array<struct<from: string, value: string>>", (1, [("human", "a"), ("gpt", "b")]), [("user", "a"), ("assistant", "b")]),
        ("conv_id long, instruction string, input string, output string", (1, "do", None, "done"), [("user", "do"), ("assistant", "done")]),
        ("conv_id long, system string, prompt string, completion string", (1, None, "p", "c"), [("user", "p"), ("assistant", "c")]),
        ("conv_id long, prompt string, completion string, text string", (1, "p", "c", "clash"), [("user", "p"), ("assistant", "c")]),
    ],
)
def test_frames_by_schema(spark, schema, row, want):
    turns = chat.canonical(spark.createDataFrame([row], schema)).orderBy("turn").collect()
    assert [(r.role, r.text) for r in turns] == want
    assert chat.canonical(spark.createDataFrame([row], schema)).dtypes == [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")]


def test_unknown_frame(spark):
    with pytest.raises(ValueError, match="fingerprint"):
        chat.canonical(spark.createDataFrame([(1, 2)], "conv_id long, a int"))


def test_no_rows(spark):
    assert chat.read(chat.formatted(spark.createDataFrame([], TURNS))).count() == 0
