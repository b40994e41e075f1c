import hashlib
import json

from cases import folder
from nearfield.llm import chat
from pyspark.sql import functions as F

CONV = "conv_id bigint, turn bigint, role string, text string, turns string, formatted string"
ROWS = [(1, 0, "user", "hi </s> [INST] <\\s> \\ <", "x", "y"), (1, 1, "assistant", "[/INST]\n</s>é[", "x", "y"), (2, 0, None, None, "x", "y"),
        (None, 3, "assistant", "no id", "x", "y"), (3, 1, "assistant", "b", "x", "y"), (3, 1, "assistant", "a", "x", "y"), (3, 1, "assistant", "a", "x", "y"),
        (4, 0, "system", "s" * 200_000, "x", "y"), (4, 1, "assistant", "", "x", "y"), (4, None, "user", "first", "x", "y")]


def test_turns_survive_and_digests_match(spark, tmp_path):
    path = folder(spark, tmp_path, conversations=spark.createDataFrame(ROWS, CONV).repartition(3))
    got = {r["conv_id"]: r for r in chat.op7_chat_formatting(spark, path).collect()}
    rows = ROWS + [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == {r[0] for r in rows}
    for conv, out in got.items():
        turns = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert out["n_turns"] == len(turns) and out["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert out["loss_chars"] == len(loss) and out["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_layouts_become_turns(spark):
    records = [{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]}, {"prompt": "p", "completion": "c"},
               {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, {"instruction": "i", "input": "", "output": "o"}, {"odd": 1}, {"messages": []}]
    df = spark.createDataFrame([(json.dumps(r), "x") for r in records] + [(None, "x"), ("not json", "x")], "record string, turns string")
    out = [(r["mapping"], [tuple(t) for t in r["turns"]]) for r in chat.canonical(df).collect()]
    assert out[:5] == [("messages", [("user", "q"), ("assistant", "")]), ("prompt_completion", [("user", "p"), ("assistant", "c")]),
                       ("conversations", [("user", "q"), ("assistant", "a")]), ("instruction_input", [("user", "i"), ("assistant", "o")]), (None, [])]
    assert all(o == (None, []) for o in out[6:])
    assert chat.layouts(df).agg(F.sum("records")).first()[0] == len(records) + 2


def test_no_rows_and_plan_is_native(spark, tmp_path, plan):
    path = folder(spark, tmp_path, conversations=spark.createDataFrame([], CONV))
    df = chat.op7_chat_formatting(spark, path)
    assert [r["conv_id"] for r in df.collect()] == [-1]
    assert "Python" not in plan(df) and "Arrow" not in plan(df) and "Pandas" not in plan(df)
