import hashlib
import json

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from paperledger.llm import chat as c

CONTROLS = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<<TEXT>>", "<</ROLE>>", "\\", " ", "\n", "a", "é\U0001f600", "<", "[", "$1"]
texts = st.lists(st.sampled_from(CONTROLS), max_size=12).map("".join)
talks = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "<<TEXT>>", " a\\"]), texts), max_size=5)


def rendered(spark, conversations):
    rows = [(i, [{"role": r, "text": t} for r, t in turns]) for i, turns in enumerate(conversations)]
    return c.formatted(spark.createDataFrame(rows, f"conv_id int, turns {c.TURNS}"))


@settings(max_examples=5, deadline=None)
@given(st.lists(talks, min_size=40, max_size=80))
def test_round_trip_of_any_text(spark_session, conversations):
    df = rendered(spark_session, conversations)
    got = df.select("conv_id", c.read_back(F.col("formatted")).alias("back"), c.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    for r in got:
        want = conversations[r.conv_id]
        assert [(t.role, t.text) for t in r.back] == want
        assert r.loss == "".join(t for role, t in want if role == "assistant")


def test_spans_cover_assistant_texts_only(spark):
    row = rendered(spark, [[("user", "hi \U0001f600"), ("assistant", "yo </s>"), ("user", ""), ("assistant", "")]]).first()
    parts = [row.formatted[s.start:s.stop] for s in row.loss_spans]
    assert parts == ["yo \\</s>", ""]
    assert row.formatted == "[INST] hi \U0001f600 [/INST]\n<s> yo \\</s> </s>\n[INST]  [/INST]\n<s>  </s>"


def test_shapes_select_mappings(spark):
    docs = [
        {"prompt": "p", "completion": "q"}, {"output": "q", "instruction": "p"}, {"system": "s", "instruction": "p", "output": None},
        {"messages": [{"role": "user", "content": "p"}, {"content": "q", "role": "tool"}]},
        {"conversations": [{"from": "human", "value": "p"}, {"from": "gpt", "value": "q"}, {"from": "system", "value": None}]},
        {"data": {"dialog": [{"speaker": "user", "utterance": "OBJECT<x: STRING>"}]}},
        {"messages": [{"role": "user", "content": 5}]}, {"question": "p"}, {"messages": []}, [1], 3, "text",
    ]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(90, "{no json"), (91, None)]
    got = {r.conv_id: r for r in c.canonical(spark.createDataFrame(rows, "conv_id long, json string")).collect()}
    assert len(got) == len(rows)
    turns = lambda i: [(t.role, t.text) for t in got[i].turns]
    assert [got[i].layout for i in range(6)] == ["prompt_completion", "instruction", "system_instruction", "messages", "from_value", "dialogue"]
    assert turns(0) == turns(1) == [("user", "p"), ("assistant", "q")] and turns(2) == [("system", "s"), ("user", "p"), ("assistant", "")]
    assert turns(3) == [("user", "p"), ("tool", "q")] and turns(4) == [("user", "p"), ("assistant", "q"), ("system", "")]
    assert turns(5) == [("user", "OBJECT<x: STRING>")] and turns(6) == [("user", "5")]
    assert all(got[i].layout is None and got[i].turns is None for i in (7, 8, 9, 10, 11, 90, 91))


def test_layouts_lose_nothing(spark):
    talks = [
        [("user", "a"), ("assistant", "b")], [("user", "ab"), ("assistant", "b")], [("system", "s"), ("user", "a"), ("assistant", "b")],
        [("user", "a")], [("assistant", "long text"), ("user", "a")], [("user", "a"), ("tool", "abc"), ("user", None)], [(None, None)],
    ]
    rows = [(i if i != 3 else None, k, r, t, "x") for i, talk in enumerate(talks) for k, (r, t) in enumerate(talk)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, json string").repartition(4)
    got = {r.conv_id: r for r in c.canonical(c.as_layouts(df)).collect()}
    for i, talk in enumerate(talks):
        assert [(t.role, t.text) for t in got[i if i != 3 else None].turns] == [(r or "", t or "") for r, t in talk]
    assert len({r.layout for r in got.values()}) >= 5


def test_long_and_empty(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", "x</s>" * 200) for k in range(1500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = c.digests(c.formatted(c.canonical(c.as_layouts(df)))).first()
    assert r.n_turns == 1500 and r.loss_chars == 750 * 1000
    assert c.digests(c.formatted(c.canonical(c.as_layouts(df.filter(F.lit(False)))))).collect() == []


def test_turns_beyond_the_parser_limit(spark):
    unit = 'x\\"\\'
    long = unit * 5_250_000
    rows = spark.createDataFrame([(1, 0, "user"), (1, 1, "assistant"), (2, 0, "user"), (2, 1, "tool"), (2, 2, "assistant")], "conv_id long, turn long, role string")
    text = F.when(F.col("turn") == 0, F.repeat(F.lit(unit), 5_250_000)).otherwise(F.lit("short"))
    done = c.canonical(c.as_layouts(rows.withColumn("text", text)))
    got = {r.conv_id: r for r in done.select("conv_id", "layout", F.transform("turns", lambda t: F.struct(t["role"], F.length(t["text"]).alias("n"), F.md5(t["text"]).alias("m"))).alias("t")).collect()}
    want = hashlib.md5(long.encode()).hexdigest()
    assert [got[i].layout for i in (1, 2)] == ["prompt_completion", "messages"]
    assert all(got[i].t[0].n == len(long) == 21_000_000 and got[i].t[0].m == want and got[i].t[-1].n == 5 for i in (1, 2))
    plain = rows.filter("conv_id = 1").withColumn("text", F.when(F.col("turn") == 0, F.repeat(F.lit("word "), 4_200_000)).otherwise(F.lit("short")))
    r = c.digests(c.formatted(c.canonical(c.as_layouts(plain)))).first()
    assert (r.n_turns, r.loss_chars, r.layout) == (2, 5, "prompt_completion")


def test_shortened_json_has_the_same_shape(spark, monkeypatch):
    docs = [{"a\\": "b\\\\", 'c"d': ['\\"', 1, {"e": "\\\\\"x" * 9000}], "n": list(range(3000))}, {"prompt": "x" * 20000, "completion": '"'}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "json string")
    want = [r[0] for r in df.select(c.shape(F.col("json"))).collect()]
    monkeypatch.setattr(c, "LONG", 0)
    got = df.select(c.shape(F.col("json")), F.length(c.shortened(F.col("json")))).collect()
    assert [r[0] for r in got] == want and None not in want and all(r[1] < 20000 for r in got)
