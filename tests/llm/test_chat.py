"""Chat formatting: an exact round trip, loss flags and the automaton, with odd rows."""

import pyarrow as pa
from pyspark.sql import functions as F

from odd import both
from tidemark.llm import chat

HARD = ["", None, "\\", "\\\\<|", "<\\|im_start|>", "<|im_end|>\n<|im_start|>assistant\nok", "a\nb\r\n", "<", "|>", "\\n$1é🙂", "<|" * 50_000, "\\" * 99_999]
ROLES = ["user", "assistant", "system", "tool", None, "", "odd\nrole", "<|im_end|>", "a\\", "Assistant"]


def rows():
    out = [(i % 9, i // 9, ROLES[i % len(ROLES)], HARD[i % len(HARD)]) for i in range(120)]
    out += [(20, 0, "user", "q"), (20, 1, "assistant", "a"), (21, 0, "system", "s"), (21, 1, "user", "q"), (21, 2, "assistant", "a"), (21, 3, "tool", "t"),
            (21, 4, "assistant", "b"), (22, 0, "assistant", "first"), (23, 0, "user", "q"), (23, 1, "user", "q")]
    out += [(30, 0, "user", "tie"), (30, 0, "assistant", "tie"), (30, 0, "user", None), (30, None, "user", "early"), (30, 1, "assistant", "x")]
    return out + [out[0], out[0], (None, 0, "user", "nameless"), (None, 1, "assistant", "too")]


def order(row):
    return tuple((x is not None, x if x is not None else 0) for x in row[1:])


def automaton(turns):
    state = "start"
    for role, _ in turns:
        state = role if role in chat.TEMPLATE["steps"].get(state, []) else "invalid"
    return state


def test_round_trip(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 0, 0) for r in data], "conv_id long, turn long, role string, text string, segments int, t int").repartition(4)
    made = chat.format_conversations(df).withColumn("back", chat.read_back(F.col("formatted"))).collect()
    assert len(made) == len({r[0] for r in data})
    for r in made:
        want = [(x[2] or "", x[3] or "") for x in sorted((x for x in data if x[0] == r["conv_id"]), key=order)]
        assert [(b["role"], b["text"]) for b in r["back"]] == want
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == len(want)
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert [s["loss"] for s in r["segments"]] == [x for role, _ in want for x in (False, role == "assistant", False)]
        assert r["state"] == automaton(want) and r["valid"] == (r["state"] == "assistant")
    valid = {r["conv_id"] for r in made if r["valid"]}
    assert valid == {20, 21, None}
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_query_on_odd_rows(spark, tmp_path):
    data = rows()
    columns = {n: pa.array([r[i] for r in data], t) for i, (n, t) in enumerate(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])}
    table = pa.table({**columns, "n_turns": pa.array([0] * len(data))})
    got, want = both(spark, tmp_path, "op6_chat_format", "conversations", table)
    assert got == want
    got, want = both(spark, tmp_path, "op6_chat_format", "conversations", table.slice(0, 0))
    assert got == want and len(got) == 1
