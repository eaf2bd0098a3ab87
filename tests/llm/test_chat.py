"""Op 2: fingerprints pick mappings, and the template gives every text back."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.llm import op2_chat as op

RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "tool", "content": None}]}, "messages", [("user", "a"), ("tool", "")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"value": "b", "from": "gpt"}, {"from": "x", "value": "c"}]}, "conversations", [("user", "a"), ("assistant", "b"), ("x", "c")]),
    ({"prompt": "p", "response": "r"}, "prompt_response", [("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "response": "r", "system": "s"}, "prompt_response", [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"completion": "c", "prompt": None}, "prompt_completion", [("user", ""), ("assistant", "c")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [("user", "i"), ("user", "x"), ("assistant", "o")]),
    ({"instruction": "i", "output": "o", "system": None}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"messages": []}, "messages", []),
    ({"messages": [{"role": "user"}]}, "unmapped", None),
    ({"question": "q"}, "unmapped", None),
]


def test_layouts(spark):
    rows = [(i, json.dumps(r), "mine", "mine") for i, (r, _, _) in enumerate(RECORDS)] + [(98, "{broken", "", ""), (99, None, "", "")]
    got = {r.i: r for r in op.canonical_turns(spark.createDataFrame(rows, "i int, json string, turns string, mapping string")).collect()}
    for i, (_, name, turns) in enumerate(RECORDS):
        assert got[i].mapping == name
        assert (None if got[i].turns is None else [tuple(t) for t in got[i].turns]) == turns
    assert got[98].mapping == got[99].mapping == "invalid" and got[98].turns is None and got[9].fingerprint != got[0].fingerprint


def test_shape_of_paths():
    assert op.shape_of(["b", "a[].x", "a[].y.z"]) == "OBJECT<a: ARRAY<OBJECT<x: _, y: OBJECT<z: _>>>, b: _>"


NASTY = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>", "<|im_end|>\n", "<|im_start|>user\n", "<", "[", "\\", "|", "\n", "%", "%0A", "é", "🙂", " ok ", "INST]", "/s>"]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a%\nb</s>", ""]), st.lists(st.sampled_from(NASTY), max_size=8).map("".join)), max_size=12))
@settings(max_examples=12, deadline=None)
def test_round_trip(spark, turns):
    df = spark.createDataFrame([(1, turns)], "i int, turns array<struct<role: string, text: string>>")
    r = op.read_back(op.format_turns(df).select("i", "formatted", "loss_runs")).first()
    assert [tuple(t) for t in r.turns_read] == turns
    assert "".join(r.loss_read) == "".join(t for role, t in turns if role == "assistant")
    assert sum(x.chars for x in r.loss_runs) == len(r.formatted)
    at, masked = 0, []
    for x in r.loss_runs:
        masked += [r.formatted[at:at + x.chars]] if x.loss else []
        at += x.chars
    assert len(masked) == len(r.loss_read) and "</s>" not in r.formatted and "[INST]" not in r.formatted


def test_rows_of_turns(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (2, 0, None, "x"), (None, 0, "user", "n"), (3, 0, "user", "t"), (3, 0, "user", "t"), (3, None, "system", "z"),
            (4, 0, "system", "s"), (4, 1, "user", "u" * 200_000), (4, 2, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("json", F.lit("mine"))
    out = op.read_back(op.format_turns(op.canonical_turns(op.pack(df))))
    got = {r.conv_id: [(t.role, t.text) for t in r.turns_read] for r in out.collect()}
    assert got == {1: [("user", ""), ("assistant", "b")], 2: [("", "x")], None: [("user", "n")], 3: [("system", "z"), ("user", "t"), ("user", "t")],
                   4: [("system", "s"), ("user", "u" * 200_000), ("assistant", "")]}
    assert op.read_back(op.format_turns(op.canonical_turns(op.pack(df.limit(0))))).count() == 0


def test_long_texts(spark):
    """A turn of over 20 million characters (the parser's limit on strings) keeps its result."""
    df = spark.range(1).select(F.concat(F.lit('{"prompt":"'), F.repeat(F.lit("word\\\\ "), 3_000_000), F.lit('","response":"b"}')).alias("json"))
    r = op.canonical_turns(df).select("mapping", F.size("turns").alias("n"), F.length(F.col("turns")[0]["text"]).alias("chars")).first()
    assert tuple(r) == ("prompt_response", 2, 18_000_000)
    df = spark.range(1).select(F.concat(F.lit('{"prompt":"'), F.repeat(F.lit("word "), 4_200_000), F.lit('","response":"b"}')).alias("json"))
    r = op.canonical_turns(df).select("mapping", F.size("turns").alias("n"), F.length(F.col("turns")[0]["text"]).alias("chars")).first()
    assert tuple(r) == ("prompt_response", 2, 21_000_000)


@pytest.mark.parametrize("json,same", [
    ('{"a":"x\\"y:","b":["c","d"]}', '{"a":"","b":["",""]}'), ('{"a:":"b" , "c" : 1}', '{"a:":"" , "c" : 1}'), ('{"a":[{"x":"1"}, {"x":"2"},{"x":"3"}]}', '{"a":[{"x":""}]}'),
    ('{"a":{"x":""},{"x":""}}', '{"a":{"x":""},{"x":""}}'), ('{"a":"x\\qy"}', '{"a":"x\\qy"}'), ('{"a":"x\ny"}', '{"a":"x\ny"}'), ('"s"', '""')])
def test_skeleton(spark, json, same):
    df = spark.createDataFrame([(json,)], "j string")
    parsed = F.schema_of_variant(F.try_parse_json("j"))
    r = df.select(op.skeleton(F.col("j")).alias("s"), parsed.alias("a"), F.schema_of_variant(F.try_parse_json(op.skeleton(F.col("j")))).alias("b")).first()
    assert r.s == same and r.a == r.b


def test_what_cannot_be_parsed_is_an_error(spark):
    long = spark.range(1).select(F.concat(F.lit('{"'), F.repeat(F.lit("k"), op.MAX_SKELETON), F.lit('":1}')).alias("json"))
    with pytest.raises(Exception, match="too long to parse"):
        op.canonical_turns(long).select("mapping").collect()


def test_plan_has_no_python(spark):
    from panelspark.llm.queries import QUERIES
    for name in ("op2_chat_format", "op5_license_scan"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian"))


@pytest.mark.parametrize("text,escaped", [("</s>", "<\\/s>"), ("<\\/s>", "<\\\\/s>"), ("[INST] [x]", "[\\INST] [x]"), ("<b>", "<b>")])
def test_escape(spark, text, escaped):
    r = spark.createDataFrame([(text,)], "t string").select(op.escape(F.col("t")).alias("e")).select("e", op.unescape(F.col("e")).alias("u")).first()
    assert (r.e, r.u) == (escaped, text)
