"""A full run covers every file, and the rules that single rows of the query tests cannot show."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from codesift import session
from codesift.functions import jsonx
from codesift.operators import grouping, metadata, scan, selection, suggest
from codesift.plans import model
from codesift.plans.catalog import catalog_frame
from codesift.sources import artifacts
from conftest import one_col


def _paths(spark, n):
    return spark.range(n).selectExpr("'r' AS repo_id", "concat('src/f', id, '.js') AS path", "concat('text ', id) AS content")


def test_every_file_is_offered_profiled_grouped_and_described(spark):
    files = _paths(spark, 1000)
    reqs = selection.selection_requests(files.select("repo_id", "path")).collect()
    assert sum(r.n_offered for r in reqs) == 1000 and len(reqs) == 5
    offered = [p for r in reqs for p in r.file_block.split("\n")]
    assert len(set(offered)) == 1000
    none = spark.createDataFrame([], "repo_id string, batch int, content string")
    chosen = selection.batched_selection_result(files, none)
    built = metadata.build_metadata(chosen, files)
    table = built["metadata"]
    assert table.count() == 1000 and built["requests"].count() == 1000
    groups = grouping.grouping_requests(table).collect()
    assert len(groups) == 17 and sum(g.files_block.count("\n") + 1 for g in groups) == 1000
    subset = spark.createDataFrame([("r", 1, "subset-001", [f"src/f{i}.js" for i in range(500)])],
                                   "repo_id string, subset_no int, subset_id string, file_paths array<string>")
    asked = suggest.suggestion_requests(subset, table, catalog_frame(spark)).first()
    assert asked.summary.count("\n") == 499 and "omitted" not in asked.summary


BAD = ['["a"]]', '["a"]] trailing', '{"a":1}] foo', '"a"], "b"', '1,"x":2}', '{"a":1},"b":1', '1}', '"v":1', "", " ", "[1,]", "{}{}"]
GOOD = ['["a"]', ' {"a": [1, {"b": null}]} ', '"]"', "null", "3", '"a\\"],\\"b"', "[]", '{"v": 1, "w": 2}']


def test_json_is_strict(spark):
    for text, ok in [(t, False) for t in BAD] + [(t, True) for t in GOOD]:
        row = one_col(spark, [text]).select(jsonx.parse_json_strict("x").isNotNull().alias("ok")).first()
        try:
            json.loads(text)
            expected = True
        except ValueError:
            expected = False
        assert row.ok == ok == expected, text


def test_selection_paths_as_users_write_them(spark):
    files = spark.createDataFrame([("r", "src/a.js"), ("r", "src/b/c.js"), ("r", "d.js")], "repo_id string, path string")
    sel = spark.createDataFrame([("r", 1, "src/"), ("r", 2, "./d.js"), ("r", 3, ".//src/./b/"), ("r", 4, "gone/")],
                                "repo_id string, pos int, path string")
    expanded, missing = metadata.expand_selection(sel, files)
    assert {r.path for r in expanded.collect()} == {"src/a.js", "src/b/c.js", "d.js"}
    assert [(r.pos, r.path) for r in missing.collect()] == [(4, "gone")]


def test_failed_answers_are_asked_again(spark):
    reqs = model.with_request(spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), "op", F.lit("s"), F.col("k"),
                              model.params())
    ids = {r.k: r.request_id for r in reqs.collect()}
    stored = spark.createDataFrame([(ids["a"], "old", "ok"), (ids["a"], None, "error"), (ids["b"], None, "error"), (ids["c"], "half", "error")],
                                   "request_id string, content string, status string")

    def provider(batches):
        for pdf in batches:
            pdf = pdf[["request_id"]].copy()
            pdf["content"], pdf["status"] = "new", "ok"
            yield pdf

    got = {r.k: (r.content, r.status) for r in model.complete(reqs, provider=provider, responses=stored).collect()}
    assert got == {"a": ("old", "ok"), "b": ("new", "ok"), "c": ("new", "ok")}


def test_excluded_directories_of_the_flattened_tree(spark):
    files = spark.createDataFrame([("r", p) for p in ("src/a.js", "coverage/a.js", "x/Archive/b.js", "Archive.js")],
                                  "repo_id string, path string")
    assert {r.path for r in selection.flattened(files).collect()} == {"src/a.js", "Archive.js"}


def test_model_line_counts_without_a_snippet(spark):
    answer = json.dumps({"vulnerabilities": [{"file_path": "a.js", "line": [4, 5]}, {"file_path": "a.js", "line": []},
                                             {"file_path": "a.js", "code_snippet": "nowhere ☃", "line": [9]}]})
    plan = spark.createDataFrame([("r", "s", 1, 0, "pipeline_xss", ["a.js"], "ok")],
                                 "repo_id string, subset_id string, suggestion_no int, pipeline_pos int, pipeline_id string, "
                                 "file_paths array<string>, plan_status string")
    stage = catalog_frame(spark).selectExpr("pipeline_id", "stages[0] AS stage")
    plan = plan.join(stage, "pipeline_id")
    files = spark.createDataFrame([("r", "a.js", "one\ntwo")], "repo_id string, path string, text string")
    reqs = scan.run_scan(plan, files)["requests"]
    stored = reqs.select("request_id").withColumn("content", F.lit(answer)).withColumn("status", F.lit("ok"))
    out = scan.run_scan(plan, files, responses=stored)
    assert [r.line for r in out["findings"].collect()] == [[4, 5]]
    assert json.loads(reqs.first().params_json)["response_format"] == {"type": "json_object"}


def test_stage_outputs_of_another_subset_stay(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="codesift-so-"), "so")
    schema = "repo_id string, subset_id string, pipeline_id string, output_tag string, save_output boolean, payload string"
    for subset, payload in (("s1", "1"), ("s2", "2"), ("s1", "3")):
        artifacts.write_stage_outputs(spark.createDataFrame([("r", subset, "p", "t", True, payload)], schema), path)
    assert {(r.subset_id, r.payload) for r in spark.read.parquet(path).collect()} == {("s1", "3"), ("s2", "2")}


def test_reports_are_markdown(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="codesift-md-"), "md")
    artifacts.write_reports(spark.createDataFrame([("a.md", "# A"), ("b.md", "# B")], "md_name string, content string"), out)
    assert sorted(d for d in os.listdir(out) if d.startswith("md_name")) == ["md_name=a.md", "md_name=b.md"]


def test_checkpoint_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session)
