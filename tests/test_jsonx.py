"""T4-T7, T11, F14, F15 and the answer parsers (G3, G5, G7, P3, E2) on the malformed-answer cases."""

from pyspark.sql import functions as F

from codesift.functions import jsonx
from codesift.operators import grouping, metadata, scan, selection, suggest
from conftest import one_col

FENCE_JSON = '```json\n["a"]\n```'
FENCE_BARE = '```\n["a"]\n```'
FENCE_JS = '```js\n["a"]\n```'
FENCE_OPEN = '```json\n["a"]'
INJ = ["pipeline_injection"]

# case -> (selection pick or None for fallback, suggestions)
CASES = {
    "": (None, INJ),
    "nope": (None, INJ),
    '["a"] xx': (None, INJ),
    '["a",]': (None, INJ),
    "[]": ([], []),
    "[null]": (None, []),
    '["a",null]': (None, ["a"]),
    '["a",1]': (None, ["a"]),
    '{"a":1}': (None, INJ),
    '{"a":1,"a":2}': (None, INJ),
    "null": (None, INJ),
    "[NaN]": (None, []),
    FENCE_JSON: (["a"], INJ),
    FENCE_BARE: (["a"], INJ),
    FENCE_JS: (None, INJ),
    FENCE_OPEN: (["a"], INJ),
    '  ["b", "c"]  ': (["b", "c"], ["b", "c"]),
}


def test_selection_answers(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "content string")
    got = {r[0]: r[1] for r in selection.parse_selection(df).collect()}
    for k, (pick, _) in CASES.items():
        assert got[k] == pick, repr(k)


def test_suggestion_answers(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "content string")
    got = {r[0]: r[1] for r in suggest.parse_suggestions(df).collect()}
    for k, (_, sug) in CASES.items():
        assert got[k] == sug, repr(k)


def test_selection_fallback_uses_all_prefiltered(spark):
    files = spark.createDataFrame([("r1", "b.js"), ("r1", "a.js"), ("r2", "c.js"), ("r3", "d.js")], "repo_id string, path string")
    answers = spark.createDataFrame([("r1", '["x.js"]'), ("r2", "oops")], "repo_id string, content string")
    got = sorted(tuple(r) for r in selection.selection_result(files, answers).collect())
    assert got == [("r1", 1, "x.js", "model"), ("r2", 1, "c.js", "fallback"), ("r3", 1, "d.js", "fallback")]


def test_fences(spark):
    cases = {
        FENCE_JSON: ('["a"]', '["a"]'),
        FENCE_JS: ('js\n["a"]', '["a"]'),
        '```json [1]```': ('[1]', '```json [1]'),
        "````": ("`", "`"),
        "```\n[1]\n```\ntrailing": ("[1]\n```\ntrailing", "[1]"),
        " plain ": ("plain", "plain"),
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r[0]: (r[1], r[2]) for r in df.select("t", jsonx.strip_fence_a("t"), jsonx.strip_fence_b("t")).collect()}
    assert got == cases


def test_summary_answers(spark):
    cases = {
        '{"summary": "s", "imports": ["a", 1, true, null]}': ("ok", "s", ["a", "1", "True", "None"]),
        "{}": ("ok", "", []),
        '{"summary": 1}': ("error", None, []),
        '{"summary": "s", "imports": "x"}': ("error", None, []),
        "[]": ("error", None, []),
        "not json": ("error", None, []),
        None: ("missing", None, []),
    }
    df = spark.createDataFrame([(k,) for k in cases], "content string")
    got = {r["content"]: (r["summary_status"], r["description"], r["imports"]) for r in metadata.parse_summary(df).collect()}
    assert got == cases


def test_grouping_answers(spark):
    answers = [
        ("r", 1, '```json\n[{"subset_id": "auth", "file_paths": ["a", "b"], "reason": "x"}, {"file_paths": ["c"]}]\n```'),
        ("r", 2, '[{"subset_id": "db", "file_paths": ["d", 5]}]'),
        ("q", 1, "[]"),
        ("q", 2, '{"a": 1}'),
        ("p", 1, "[1]"),
    ]
    df = spark.createDataFrame(answers, "repo_id string, chunk int, content string")
    res = grouping.parse_grouping(df)
    subs = sorted((r.repo_id, r.subset_no, r.subset_id, r.chunk_subset_id, r.file_paths)
                  for r in res["subsets"].collect())
    assert subs == [("r", 1, "subset-001", "auth-chunk01", ["a", "b"]),
                    ("r", 2, "subset-002", "subset-chunk01", ["c"]),
                    ("r", 3, "subset-003", "db-chunk02", ["d"])]
    status = {(r.repo_id, r.chunk): r.chunk_status for r in res["chunk_status"].collect()}
    assert status == {("r", 1): "ok", ("r", 2): "ok", ("q", 1): "error", ("q", 2): "error", ("p", 1): "error"}
    assert [r.repo_id for r in res["ok_repos"].collect()] == ["r"]


def test_grouping_strict_raises(spark):
    import pytest
    df = spark.createDataFrame([("q", 1, "[]")], "repo_id string, chunk int, content string")
    with pytest.raises(Exception):
        grouping.parse_grouping(df, strict=True)["subsets"].collect()


def test_findings_answers(spark):
    f = '{"file_path": "a.js", "code_snippet": "x", "description": "d", "vulnerability": "v", ' \
        '"severity": "High", "confidence_level": "Low", "remediation": "r"}'
    answers = [
        ("1", '{"vulnerabilities": [' + f + ', "junk"]}'),
        ("2", "[" + f + "]"),
        ("3", '{"other": 1}'),
        ("4", "not json"),
        ("5", '{"vulnerabilities": "x"}'),
    ]
    df = spark.createDataFrame(answers, "request_id string, content string")
    res = scan.parse_findings(df)
    n = {r[0]: r[1] for r in res["findings"].groupBy("request_id").count().collect()}
    assert n == {"1": 1, "2": 1}
    st = {r.request_id: r.answer_status for r in res["answer_status"].collect()}
    assert st == {"1": "ok", "2": "ok", "3": "no_findings_key", "4": "not_json", "5": "bad_vulnerabilities"}
    raw = {r.request_id: r.payload for r in res["stage_outputs"].collect()}
    assert raw["4"] == '{"raw_output":"not json"}'


def test_check_findings(spark):
    df = spark.createDataFrame([("a", "d", "v", "Severe", "High", None)],
                               "file_path string, description string, vulnerability string, severity string, "
                               "confidence_level string, remediation string")
    v = scan.check_findings(df).first()["violations"]
    assert v == ["missing:remediation", "bad_enum:severity"]


def test_params_json(spark):
    df = spark.createDataFrame([("m", None, 0, False)], "model string, temperature double, max_tokens int, stream boolean")
    got = df.select(jsonx.params_json(F.struct("model", "temperature", "max_tokens", "stream"))).first()[0]
    assert got == '{"model":"m","max_tokens":0,"stream":false}'


def test_strict_parse_python_fallback(spark):
    df = one_col(spark, ['{"a": 1, "a": 2}', "[Infinity, -Infinity]", '"\\ud83d\\ude00"'])
    rows = df.select("x", F.to_json(jsonx.parse_json_strict("x"))).collect()
    got = dict(rows)
    assert got['{"a": 1, "a": 2}'] == '{"a":2}'          # last duplicate wins, as in Python
    assert got["[Infinity, -Infinity]"] is not None     # accepted, numbers
