"""L2 end to end: plan -> bundle -> requests -> provider -> findings located, relativised, ordered."""

import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from codesift.operators import scan
from codesift.operators.metrics import observed
from codesift.plans.catalog import catalog_frame

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import this test module

ROOT = "/work/app"
FILES = {
    "api/user.js": "const q = 'SELECT * FROM users WHERE id=' + id;\ndb.query(q);\n",
    "web/view.jsx": "function V(p) {\n  return <div dangerouslySetInnerHTML={{__html: p.bio}} />;\n}\n",
}


def provider(batches):
    """Answers every scan request with one finding per bundled file, quoting its first line
    (absolute path, as a model reading the bundle would) plus one finding that cannot be located."""
    for pdf in batches:
        out = []
        for rid, msgs in zip(pdf["request_id"], pdf["messages_json"]):
            user = json.loads(msgs)[1]["content"]
            found = []
            for line in user.split("\n"):
                if line.startswith("FILE: "):
                    path = line[len("FILE: "):]
                    rel = path[len(ROOT) + 1:]
                    found.append({"file_path": path, "code_snippet": FILES[rel].split("\n")[0],
                                  "description": "d", "vulnerability": "v", "severity": "High",
                                  "confidence_level": "High", "remediation": "r"})
            found.append({"file_path": ROOT + "/api/user.js", "code_snippet": "☃☃☃☃☃☃☃",
                          "description": "d", "vulnerability": "v", "severity": "Low",
                          "confidence_level": "Low", "remediation": "r"})
            out.append((rid, json.dumps({"vulnerabilities": found}), "ok"))
        yield pd.DataFrame(out, columns=["request_id", "content", "status"])


def test_run_scan(spark):
    files = spark.createDataFrame([("r", p, t) for p, t in FILES.items()], "repo_id string, path string, text string")
    subsets = spark.createDataFrame([("r", 1, "subset-001", ["api/user.js", "web/view.jsx"])],
                                    "repo_id string, subset_no int, subset_id string, file_paths array<string>")
    sugg = spark.createDataFrame([("r", 1, "subset-001", ["pipeline_injection", "pipeline_xss"])],
                                 "repo_id string, subset_no int, subset_id string, suggested_pipelines array<string>")
    plan = scan.plan_runs(sugg, subsets, catalog_frame(spark))
    res = scan.run_scan(plan, files, provider=provider, root=ROOT)
    rows = res["findings"].orderBy("suggestion_no", "pipeline_pos", "pos").select(
        "pipeline_id", "pos", "file_path", "line").collect()
    assert [tuple(r) for r in rows] == [
        ("pipeline_injection", 0, "api/user.js", [1]), ("pipeline_injection", 1, "web/view.jsx", [1]),
        ("pipeline_xss", 0, "api/user.js", [1]), ("pipeline_xss", 1, "web/view.jsx", [1]),
    ]
    assert res["removed"].first()["n_removed"] == 2
    ops = sorted(r.operation for r in res["requests"].select("operation").collect())
    assert ops == ["pipeline-stage-injection_analysis", "pipeline-stage-xss_analysis"]
    user = res["requests"].select(F.col("messages")[1]["content"]).first()[0]
    assert user.startswith("```\n\n=====\nFILE: /work/app/api/user.js\n=====\n") and user.endswith("\n```")


def _plan(spark, subsets, pipelines):
    cols = "repo_id string, subset_no int, subset_id string, "
    sub = spark.createDataFrame([("r", i, n, paths) for i, (n, paths) in enumerate(subsets.items())], cols + "file_paths array<string>")
    sug = spark.createDataFrame([("r", i, n, pipelines) for i, n in enumerate(subsets)], cols + "suggested_pipelines array<string>")
    return scan.plan_runs(sug, sub, catalog_frame(spark))


def test_bundle_digests(spark):
    """Equal bundles have equal digests; text, order, path, cut and root change them.  Sizes are those of the bundle."""
    files = spark.createDataFrame([("r", "a", "AAé"), ("r", "b", "B"), ("r", "c", "B")], "repo_id string, path string, text string")
    subsets = spark.createDataFrame([("r", "1", ["a", "b"]), ("r", "2", ["a", "b"]), ("r", "3", ["b", "a"]), ("r", "4", ["a", "c"]),
                                     ("r", "5", ["none"]), ("r", "6", [])], "repo_id string, subset_id string, file_paths array<string>")
    got = {r.subset_id: r for r in scan.bundle_context(subsets, files).collect()}
    assert got["1"].bundle_digest == got["2"].bundle_digest
    assert len({got[k].bundle_digest for k in "1345"}) == 4 and got["5"].bundle_digest == got["6"].bundle_digest
    assert all(r.bundle_bytes == len(r.bundle.encode()) and r.bundle_status == "ok" for r in got.values())
    other = {r.subset_id: r.bundle_digest for how in ({"root": "/x"}, {"max_chars": 9}) for r in scan.bundle_index(subsets, files, **how).collect()}
    assert other["1"] not in {r.bundle_digest for r in got.values()}
    small = {r.subset_id: (r.bundle is None, r.bundle_status) for r in scan.bundle_context(subsets, files, max_bytes=100).collect()}
    assert small["1"] == (True, "too_large") and small["5"] == (False, "ok")
    # the guard counts what a cut leaves, also of one long file
    long = spark.createDataFrame([("r", "a", "x" * 5000), ("r", "b", "B")], "repo_id string, path string, text string")
    cut = scan.bundle_context(subsets, long, max_chars=20, max_bytes=100).filter("subset_id = '1'").first()
    assert cut.bundle_status == "ok" and cut.bundle == "\n=====\nFILE: a\n=====\nx"[:20]


def test_replayed_scan_builds_no_bundle(spark, monkeypatch):
    """Answers are found by digests: with all of them stored the texts' assembly is never asked for; one that is missing
    brings only its own subset's bundle to the provider.  A bundle above the guard ends as a status row."""
    texts = dict(FILES, **{"big.js": "b" * 3000})
    files = spark.createDataFrame([("r", p, t) for p, t in texts.items()], "repo_id string, path string, text string")
    plan = _plan(spark, {"s1": ["api/user.js"], "s2": ["web/view.jsx"], "s3": ["big.js"]}, ["pipeline_injection", "pipeline_xss"])
    first = scan.run_scan(plan, files, provider=provider, root=ROOT, max_bytes=1000)
    status = {(r.subset_id, r.pipeline_id): r.answer_status for r in first["answer_status"].collect()}
    assert {k: v for k, v in status.items() if k[0] != "s3"} == {(s, p): "ok" for s in ("s1", "s2") for p in ("pipeline_injection", "pipeline_xss")}
    assert status["s3", "pipeline_xss"] == status["s3", "pipeline_injection"] == "bundle_too_large"
    assert sorted(r.subset_id for r in first["requests"].collect()) == ["s1", "s1", "s2", "s2"]
    stored = first["requests"].select("request_id", "subset_id", F.lit('{"vulnerabilities": []}').alias("content"), F.lit("ok").alias("status"))
    assert {r.request_id for r in stored.collect()} == {r.request_id for r in scan.scan_requests(
        plan, scan.bundle_context(plan.select("repo_id", "subset_id", "file_paths").distinct(), files, root=ROOT, max_bytes=1000)).collect()}
    built = []
    assemble = scan._assemble
    monkeypatch.setattr(scan, "_assemble", lambda subsets, *a: built.append(sorted(r.subset_id for r in subsets.collect())) or assemble(subsets, *a))
    scan.run_scan(plan, files, provider=provider, responses=stored.filter("subset_id = 's1'"), root=ROOT, max_bytes=1000)
    assert built[0] == ["s2"]


def test_counts_come_with_the_findings(spark):
    """The totals are observed on the pass that writes the findings; neither kept nor removed ones scan files or answers again."""
    files = spark.createDataFrame([("r", p, t) for p, t in FILES.items()], "repo_id string, path string, text string")
    res = scan.run_scan(_plan(spark, {"s1": list(FILES)}, ["pipeline_xss"]), files, provider=provider, root=ROOT)
    assert res["counts"] == {"findings": 3, "located": 2}
    assert res["findings"].count() == 2 and [tuple(r) for r in res["removed"].collect()] == [("r", 1)]
    for name in ("findings", "removed"):
        plan = res[name]._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 and not any(x in plan for x in ("Join", "Python", "MapInPandas", "LogicalRDD")), name


def test_observed_without_rows(spark):
    out, counts = observed(spark.range(0), "none", n=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    assert out.count() == 0 and counts == {"n": 0, "odd": 0}
