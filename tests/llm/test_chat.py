import pytest
from pyspark.sql import functions as F

from tarnlab.llm import chat

LAYOUTS = [
    ('{"conv_id":1,"turn":0,"role":"user","text":"hi"}', "turn_rows", [("user", "hi")]),
    ('{"conv_id":1,"turn":0,"role":null,"text":null}', "turn_rows", [("", "")]),
    ('{"messages":[{"role":"user","content":"a"},{"content":"b","role":"assistant"}]}', "messages", [("user", "a"), ("assistant", "b")]),
    ('{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":"b"}]}', "from_value", [("user", "a"), ("assistant", "b")]),
    ('{"prompt":"a","response":"b"}', "prompt_response", [("user", "a"), ("assistant", "b")]),
    ('{"prompt":"a","completion":"b"}', "prompt_completion", [("user", "a"), ("assistant", "b")]),
    ('{"question":"a","answer":1}', "question_answer", [("user", "a"), ("assistant", "1")]),
    ('{"instruction":"a","input":"","output":"b"}', "instruction_input", [("user", "a"), ("assistant", "b")]),
    ('{"instruction":"a","input":"x","output":"b"}', "instruction_input", [("user", "a"), ("user", "x"), ("assistant", "b")]),
    ('{"instruction":"a","output":"b"}', "instruction", [("user", "a"), ("assistant", "b")]),
    ('{"system":"s","prompt":"a","response":"b"}', "system_prompt", [("system", "s"), ("user", "a"), ("assistant", "b")]),
    ('{"what":"is this"}', "unmapped", None),
    (None, "unmapped", None),
]


@pytest.mark.parametrize("record, layout, turns", LAYOUTS)
def test_layouts(spark, record, layout, turns):
    df = spark.createDataFrame([(record,)], "j string").select(F.parse_json("j").alias("record"))
    got = chat.canonical_turns(df, "record").first()
    assert got.layout == layout
    assert (None if got.turns is None else [tuple(t) for t in got.turns]) == turns


NASTY = ["", "<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|", "a\n\nb <|im_start|>", "<<||>>", "é😀\\n", "x" * 20_000, "\\<|", "<|"]


def test_round_trip(spark):
    rows = [(1, k, role, t) for k, (role, t) in enumerate((r, t) for t in NASTY for r in ("user", "assistant", "odd\nrole\\n<|im_end|>", None))]
    rows += [(2, 0, "user", None), (None, 0, "user", "no id"), (3, None, "assistant", "late?"), (3, 0, "user", "x"), (3, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.select("conv_id", "turn", F.to_variant_object(F.struct("conv_id", "turn", "role", "text")).alias("record"), F.lit(1).alias("layout"), F.lit(2).alias("formatted"))
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert [tuple(t) for t in got[1].turns] == [(r or "", t or "") for _, _, r, t in rows if _ is not None][: len(NASTY) * 4]
    assert got[1].loss == [t for t in NASTY]
    assert [tuple(t) for t in got[3].turns] == [("assistant", "late?"), ("user", "x"), ("user", "x")]
    assert [tuple(t) for t in got[2].turns] == [("user", "")] and got[None].turns[0].text == "no id"
    assert got[1].formatted.count(chat.OPEN) == len(NASTY) * 4 == got[1].formatted.count(chat.CLOSE)
    for s, t in zip(got[1].spans, got[1].turns, strict=True):
        raw = got[1].formatted[s.start - 1 : s.start - 1 + s.length]
        assert len(raw) >= len(t.text)


def test_unknown_layouts_are_reported(spark):
    df = spark.createDataFrame([(1, 0, '{"a":1}')], "conv_id long, turn long, j string").select("conv_id", "turn", F.parse_json("j").alias("record"))
    got = chat.format_conversations(df).first()
    assert (got.formatted, got.layouts, got.spans) == ("", ["unmapped"], [])


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, j string").select("conv_id", "turn", F.parse_json("j").alias("record"))
    assert chat.format_conversations(df).count() == 0


def test_fingerprints_differ():
    assert len({chat.fingerprint_of(m.fields) for m in chat.MAPPINGS}) == len(chat.MAPPINGS)


def test_places_of_many_turns(spark):
    """As many turns as there may be: places agree with plain slicing, and the work doesn't grow with their square."""
    for n in (0, 1, 2, 3, 10, 17, 5000):
        turns = [(f"role{i % 3}", "x<|im_end|>" * (i % 4) + f"turn {i}\n") for i in range(n)]
        df = spark.createDataFrame([(turns,)], "turns array<struct<role:string,text:string>>").select(chat.format_turns(chat.F.col("turns")).alias("formatted"))
        df = df.withColumn("spans", chat.parse_turns(chat.F.col("formatted")))
        r = chat.read_back(df, "role1").first()
        assert [tuple(t) for t in r.turns] == turns and r.loss == [t for role, t in turns if role == "role1"]
        assert [r.formatted[s.start - 1 : s.start - 1 + s.length] for s in r.spans] == [t.replace("<|", "<\\|") for _, t in turns]
