"""Readers of the original JSON documents, partitioned writers, report export."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from codesift.operators import metadata
from codesift.plans.catalog import DEFAULT_PIPELINES, parse_catalog_json
from codesift.sources import artifacts


def test_document_readers(spark):
    subsets = [{"subset_id": "subset-001", "file_paths": ["a.js", "b.js"], "reason": "r"}, {"subset_id": "subset-002"}]
    sugg = [{"subset_id": "subset-001", "suggested_pipelines": ["pipeline_xss"]}]
    finds = {"vulnerabilities": [{"file_path": "a.js", "code_snippet": "x", "severity": "High", "line": [3, 4]}]}
    meta = {"b.js": {"kind": "file", "language": "js", "loc": 2, "imports": [], "description": "d", "sha1": "h",
                     "token_estimate": 1},
            "a.js": {"kind": "file", "language": "js", "loc": 1, "imports": ["x"], "description": "e", "sha1": "g",
                     "token_estimate": 1}}
    docs = spark.createDataFrame([("r", json.dumps(subsets), json.dumps(sugg), json.dumps(finds), json.dumps(meta))],
                                 "repo_id string, s string, g string, f string, m string")
    s = [(r.subset_no, r.subset_id, r.file_paths) for r in artifacts.subsets_from_json(docs, "s").collect()]
    assert s == [(1, "subset-001", ["a.js", "b.js"]), (2, "subset-002", [])]
    g = [(r.subset_id, r.suggested_pipelines) for r in artifacts.suggestions_from_json(docs, "g").collect()]
    assert g == [("subset-001", ["pipeline_xss"])]
    f = artifacts.findings_from_json(docs, "f").first()
    assert (f.file_path, f.line, f.finding_id) == ("a.js", [3, 4], "r#0")
    m = {r.path: r.ord for r in metadata.metadata_from_json(docs, "m").collect()}
    assert m == {"b.js": 1, "a.js": 2}   # document order is the ord


def test_catalog_roundtrip(spark):
    cat = parse_catalog_json(spark, json.dumps({"pipelines": DEFAULT_PIPELINES}))
    rows = cat.orderBy("pipeline_pos").collect()
    assert [r.pipeline_id for r in rows] == ["pipeline_injection", "pipeline_auth", "pipeline_xss"]
    assert json.loads(rows[0].stages[0].example_json)[0]["vulnerability"] == "SQL Injection"


def test_export_reports(spark):
    docs = spark.createDataFrame([
        ("a.json", json.dumps({"content": "# A"})),
        ("b.json", json.dumps({"content": 5})),
        ("c.json", json.dumps(["x"])),
        ("d.json", "{bad"),
    ], "file_name string, json string")
    got = [tuple(r) for r in artifacts.export_reports(docs).collect()]
    assert got == [("a.md", "# A")]


def test_writers(spark):
    base = tempfile.mkdtemp(prefix="codesift-art-")
    df = spark.createDataFrame([("r1", "a", 1), ("r2", "b", 2)], "repo_id string, path string, n int")
    out = os.path.join(base, "t")
    artifacts.write_table(df, out)
    artifacts.write_table(spark.createDataFrame([("r1", "z", 9)], "repo_id string, path string, n int"), out)
    got = sorted((r.repo_id, r.path) for r in spark.read.parquet(out).collect())
    assert got == [("r1", "z"), ("r2", "b")]   # only the repo present was replaced
    so = spark.createDataFrame([("r", "s1", "p", "tag", True, '{"a":1}'), ("r", "s2", "p", "tag", False, "{}")],
                               "repo_id string, subset_id string, pipeline_id string, output_tag string, "
                               "save_output boolean, payload string")
    artifacts.write_stage_outputs(so, os.path.join(base, "so"))
    back = spark.read.parquet(os.path.join(base, "so"))
    assert [r.subset_id for r in back.collect()] == ["s1"]
    assert back.filter(F.col("output_tag") == "tag").count() == 1
