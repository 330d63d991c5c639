import hashlib
import json

from codesift.llm import chat

CONTROLS = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\|end|>", "<|turn|>x<|text|>y<|end|>", "<<SYS>> a <</SYS>>", "<", "[", "\\", "<|",
            "a<\n|b|>", "ends with <", "[\\/INST]", "", "üñ<|é|>", "<<|end|>"]


def _records(rows):
    return [(i, json.dumps(r) if r is not None else None) for i, r in rows]


def _run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, record string")
    return {r.conv_id: r for r in chat.read_back(chat.format_turns(chat.canonical_turns(df))).collect()}


def test_layouts_become_the_same_turns(spark):
    layouts = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "completion": "a"},
        {"output": "a", "instruction": "q"},
        {"instruction": "q", "input": None, "output": "a"},
    ]
    got = _run(spark, _records(enumerate(layouts)))
    assert len(got) == len(layouts)
    for row in got.values():
        assert [(t.role, t.text) for t in row.turns] == [("user", "q"), ("assistant", "a")]
        assert row.loss_texts == ["a"]


def test_control_strings_come_back(spark):
    rows = [(0, json.dumps({"turn": i, "role": "assistant" if i % 2 else "user", "text": t})) for i, t in enumerate(CONTROLS)]
    row = _run(spark, rows)[0]
    assert [t.text for t in row.turns] == CONTROLS
    assert row.loss_texts == CONTROLS[1::2]
    assert row.formatted.count("<|turn|>") == len(CONTROLS) and "</s>" not in row.formatted and "[INST]" not in row.formatted


def test_spans_are_code_points(spark):
    rows = [(0, json.dumps({"turn": i, "role": "assistant" if i % 2 else "user", "text": t})) for i, t in enumerate(CONTROLS)]
    df = spark.createDataFrame(rows, "conv_id bigint, record string")
    row = chat.format_turns(chat.canonical_turns(df)).first()
    for span in row.spans:
        assert row.formatted[span.start:].startswith("<|turn|>")
        assert row.formatted[span.text_start - 8:span.text_start] == "<|text|>"
        assert row.formatted[span.text_end:span.text_end + 7] == "<|end|>"


def test_nulls_ties_repeats_and_unmapped(spark):
    turn = {"turn": 0, "role": "user", "text": "b"}
    rows = [(1, json.dumps(turn)), (1, json.dumps(turn)), (1, json.dumps({**turn, "text": "a"})),
            (2, json.dumps({"turn": 3, "role": None, "text": None})), (None, json.dumps(turn)),
            (3, json.dumps({"strange": 1})), (4, "no json"), (5, None), (6, json.dumps([1, 2])),
            (7, json.dumps({"turn": 0, "role": "user", "text": "long " * 50000}))]
    got = _run(spark, rows)
    assert [t.text for t in got[1].turns] == ["a", "b", "b"]
    assert [(t.role, t.text) for t in got[2].turns] == [("", "")]
    assert None in got and len(got[7].turns[0].text) == 250000
    df = spark.createDataFrame(rows, "conv_id bigint, record string")
    assert {r.conv_id for r in chat.unmapped(df).collect()} == {3, 4, 5, 6}
    assert chat.format_turns(chat.canonical_turns(df.limit(0))).count() == 0


def test_fingerprint_ignores_values_and_order(spark):
    from pyspark.sql import functions as F

    def prints(*texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        return [r[0] for r in df.select(chat.fingerprint(F.parse_json("t"))).collect()]

    a, b, c, d = prints('{"x": 1, "y": {"z": "s"}}', '{"y": {"z": null}, "x": true}', '{"x": 1, "y": {"w": 1}}', '{"X": 1, "y": {"z": 1}}')
    assert a == b and len({a, c, d}) == 3


def test_query_digests(spark):
    from codesift.llm.queries import q_schema_fingerprint
    from conftest import SF_SMALL

    row = q_schema_fingerprint(spark, SF_SMALL).filter("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_texts_above_the_variant_limit(spark):
    from pyspark.sql import functions as F

    # 21,000,000 characters, made by the tasks: a literal of that length would be in every plan
    long = F.repeat(F.lit("0123456789"), (F.col("id") + 2_100_000).cast("int"))
    text = F.concat(F.lit('a"b\\c": "\n, '), long)
    role = F.lit("assistant")
    # the end of the record is a string with a broken escape
    bad = F.concat(F.lit('{"prompt": "'), long, F.lit('\\q", "completion": ""}'))
    records = [
        F.to_json(F.struct(F.lit(0).alias("turn"), role.alias("role"), text.alias("text"))),
        F.to_json(F.struct(F.array(F.struct(F.lit("user").alias("role"), F.lit("").alias("content")),
                                   F.struct(role.alias("role"), text.alias("content"))).alias("messages"))),
        F.to_json(F.struct(F.lit("q").alias("prompt"), text.alias("completion"))), bad,
    ]
    one = spark.range(1)
    df = one.select(F.lit(0).alias("conv_id"), records[0].alias("record"))
    for i, r in enumerate(records[1:], 1):
        df = df.unionByName(one.select(F.lit(i).alias("conv_id"), r.alias("record")))
    want = hashlib.sha256(('a"b\\c": "\n, ' + "0123456789" * 2_100_000).encode()).hexdigest()
    turns = chat.canonical_turns(df).select("conv_id", "pos", "role", F.length("text"), F.sha2("text", 256)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, turns)) == [
        (0, 0, "assistant", 21_000_012, want), (1, 0, "user", 0, empty), (1, 1, "assistant", 21_000_012, want),
        (2, 0, "user", 1, hashlib.sha256(b"q").hexdigest()), (2, 1, "assistant", 21_000_012, want)]
    assert [r.conv_id for r in chat.unmapped(df).select("conv_id").collect()] == [3]
    row = chat.read_back(chat.format_turns(chat.canonical_turns(df.filter("conv_id = 0")))).select(
        F.sha2(F.col("loss_texts")[0], 256)).first()
    assert row[0] == want
