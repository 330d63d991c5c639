"""K2: staged pipelines; the graph's levels and statuses, injected outputs, replay of stored answers."""

import json

from pyspark.sql import functions as F

from codesift.operators import scan, stages
from codesift.plans.catalog import catalog_frame


def stage(name, out=None, inp=None, save=True):
    return {"id": name, "title": name, "prompt_template": f"Do {name}.", "inject_previous_output": inp is not None, "input_tag": inp,
            "save_output": save, "output_tag": out, "example": []}


PIPELINES = [
    {"pipeline_id": "two", "stages": [stage("detect", "found"), stage("mend", "mended", "found")]},
    {"pipeline_id": "three", "stages": [stage("mend", "mended", "found"), stage("detect", "found"), stage("rank", "ranked", "mended")]},
    {"pipeline_id": "gap", "stages": [stage("mend", "mended", "nothing"), stage("rank", "ranked", "mended"), stage("alone", "a")]},
    {"pipeline_id": "ring", "stages": [stage("a", "x", "y"), stage("b", "y", "x"), stage("c", "z", "y"), stage("d", "w", "w")]},
    {"pipeline_id": "unsaved", "stages": [stage("a", "x", save=False), stage("b", "y", "x")]},
    {"pipeline_id": "none", "stages": []},
]


def test_graph(spark):
    got = {(r.pipeline_id, r.stage_no): (r.level, r.stage_status) for r in stages.stage_graph(catalog_frame(spark, PIPELINES)).collect()}
    assert got == {
        ("two", 0): (0, "ok"), ("two", 1): (1, "ok"),
        ("three", 0): (1, "ok"), ("three", 1): (0, "ok"), ("three", 2): (2, "ok"),
        ("gap", 0): (None, "unknown_tag"), ("gap", 1): (None, "blocked"), ("gap", 2): (0, "ok"),
        ("ring", 0): (None, "cycle"), ("ring", 1): (None, "cycle"), ("ring", 2): (None, "cycle"), ("ring", 3): (None, "cycle"),
        ("unsaved", 0): (0, "ok"), ("unsaved", 1): (None, "unknown_tag"),
    }


def model():
    """A provider: detection reports the first file, later stages add a word to what they are given; the second subset's
    detection is answered without JSON."""
    head, mid, tail = stages.INPUT_HEAD, stages.INPUT_MID, stages.INPUT_TAIL

    def run(batches):
        import json

        import pandas as pd

        for pdf in batches:
            out = []
            for text in pdf["messages_json"]:
                user = json.loads(text)[1]["content"]
                if head in user:
                    before = json.loads(user.split(mid)[1][:-len(tail)])
                    for f in before.get("vulnerabilities", []):
                        f["remediation"] = f.get("remediation", "") + "fix;"
                    out.append(json.dumps(before))
                else:
                    path = user.split("FILE: ")[1].split("\n")[0]
                    out.append("no json" if path == "c.js" else json.dumps({"vulnerabilities": [{"file_path": path, "code_snippet": "x"}]}))
            yield pd.DataFrame({"request_id": pdf["request_id"], "content": out, "status": "ok"})

    return run


def inputs(spark):
    catalog = catalog_frame(spark, PIPELINES)
    files = spark.createDataFrame([("r", "a.js", "x\n"), ("r", "c.js", "y\n")], "repo_id string, path string, text string")
    subsets = spark.createDataFrame([("r", "s1", 1, ["a.js"]), ("r", "s2", 2, ["c.js"])],
                                    "repo_id string, subset_id string, subset_no int, file_paths array<string>")
    plan = scan.plan_runs(subsets.withColumn("suggested_pipelines", F.array(*[F.lit(p["pipeline_id"]) for p in PIPELINES])), subsets, catalog)
    return plan, catalog, files


def test_levels_feed_each_other_and_replay(spark):
    plan, catalog, files = inputs(spark)
    first = stages.run_stages(plan, catalog, files, provider=model())
    status = {(r.subset_id, r.pipeline_id, r.stage_id): (r.level, r.stage_status) for r in first["stages"].collect()}
    assert len(status) == 2 * 14 and status["s1", "three", "rank"] == (2, "ok") and status["s1", "ring", "c"] == (None, "cycle")
    found = {(r.subset_id, r.pipeline_id, r.stage_no): r.remediation for r in first["findings"].collect()}
    assert found == {("s1", "two", 1): "fix;", ("s1", "three", 2): "fix;fix;", ("s1", "gap", 2): None, ("s1", "unsaved", 0): None}
    outputs = {(r.subset_id, r.pipeline_id, r.output_tag): json.loads(r.payload) for r in first["outputs"].collect()}
    assert outputs["s2", "two", "found"] == {"raw_output": "no json"} and ("s1", "unsaved", "x") not in outputs

    stored = first["responses"]
    again = stages.run_stages(plan, catalog, files, responses=stored)
    assert {tuple(r) for r in again["stages"].collect()} == {tuple(r) for r in first["stages"].collect()}
    # without the answers of the first level the second has no input, unless an earlier run saved it
    mends = first["requests"].filter("stage.id <> 'detect'").select("request_id")
    part = stored.join(mends, "request_id", "left_semi")
    lost = {(r.subset_id, r.pipeline_id, r.stage_id): r.stage_status for r in
            stages.run_stages(plan, catalog, files, responses=part)["stages"].collect()}
    assert lost["s1", "two", "detect"] == "no_answer" and lost["s1", "two", "mend"] == "missing_input" and lost["s1", "three", "rank"] == "missing_input"
    kept = {(r.subset_id, r.pipeline_id, r.stage_id): r.stage_status for r in
            stages.run_stages(plan, catalog, files, responses=part, saved=first["outputs"])["stages"].collect()}
    assert kept["s1", "two", "mend"] == "ok" and kept["s1", "three", "rank"] == "ok"


def test_nothing_to_run(spark):
    plan, _, files = inputs(spark)
    ring = catalog_frame(spark, [p for p in PIPELINES if p["pipeline_id"] in ("ring", "none")])
    got = stages.run_stages(plan, ring, files, provider=model())
    assert {r.stage_status for r in got["stages"].collect()} == {"cycle"}
    assert got["outputs"].count() == 0
