"""S6, S9, S10 as files: typed reading with error rows, exports larger than a task, one Markdown file per report."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from codesift.sources import artifacts, documents


def _folder(name):
    return os.path.join(tempfile.mkdtemp(prefix="codesift-doc-"), name)


def _put(folder, files):
    os.makedirs(folder)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(text)


def test_read_artifact(spark):
    folder = _folder("subsets")
    good = [{"subset_id": "s1", "file_paths": ["a", "b"], "reason": "r"}, {"subset_id": "s2"}]
    _put(folder, {"r1.json": json.dumps(good), "a%2Fb+c d.json": json.dumps(good[:1]), "cut.json": '[{"subset_id": "s1"', "empty.json": "",
                  "object.json": "{}", "entry.json": '[{"subset_id": "s1"}, {"subset_id": 5}]', "paths.json": '[{"subset_id": "x", "file_paths": "a"}]',
                  "none.json": "[]"})
    rows, errors = documents.read_artifact(spark, "subsets", folder)
    got = sorted((r.repo_id, r.subset_no, r.subset_id, r.file_paths) for r in rows.collect())
    assert got == [("a/b+c d", 1, "s1", ["a", "b"]), ("r1", 1, "s1", ["a", "b"]), ("r1", 2, "s2", [])]
    bad = {r.repo_id: (r.file_name, r.error) for r in errors.collect()}
    assert bad == {"cut": ("cut.json", "not_json"), "empty": ("empty.json", "not_json"), "object": ("object.json", "not_a_document"),
                   "entry": ("entry.json", "bad_entry:1"), "paths": ("paths.json", "bad_entry:0")}


def test_read_other_kinds(spark):
    folder = _folder("x")
    _put(folder, {"s.json": '[{"subset_id": "a", "suggested_pipelines": ["p"]}]', "f.json": '{"vulnerabilities": [{"file_path": "a", "line": [1]}]}',
                  "m.json": '{"b": {"loc": 2}, "a": {"loc": 1}}'})
    want = {"suggestions": ("s", "bad"), "findings": ("f", "bad"), "metadata": ("m", "bad")}
    for kind, (name, _) in want.items():
        rows, errors = documents.read_artifact(spark, kind, f"{folder}/{name}.json")
        assert {r.repo_id for r in rows.collect()} == {name} and errors.count() == 0, kind
        rows, errors = documents.read_artifact(spark, kind, folder)
        assert rows.count() >= 1 and all(r.error in ("not_a_document", "bad_entry:0") for r in errors.collect())
    with pytest.raises(FileNotFoundError):
        documents.read_artifact(spark, "metadata", folder + "/missing.json")
    with pytest.raises(ValueError):
        documents.read_artifact(spark, "nothing", folder)


def test_export_equals_the_document(spark):
    n = F.col("id")
    f = spark.range(6000).select(
        F.when(n % 3 > 0, F.lit("hot/é")).when(n < 10, F.lit("small")).otherwise(F.lit("mid +%")).alias("repo_id"),
        (n % 7).cast("int").alias("suggestion_no"), (n % 2).cast("int").alias("pipeline_pos"), (n / 14).cast("bigint").alias("pos"),
        F.concat(F.lit("f"), n).alias("file_path"), F.when(n % 5 > 0, F.lit('a "quoted"\n line')).alias("code_snippet"), F.sha1(n.cast("string")).alias("description"),
        F.lit("v").alias("vulnerability"), F.lit("High").alias("severity"), F.lit("Low").alias("confidence_level"), F.lit("r").alias("remediation"),
        F.when(n % 4 > 0, F.array(F.lit(1), F.lit(2))).alias("line")).repartition(6)
    out = _folder("findings")
    files = {r.repo_id: r for r in documents.export_findings(f, out).collect()}
    assert sorted(os.listdir(out)) == sorted(os.path.basename(r.file) for r in files.values())
    want = {r.repo_id: json.loads(r.json) for r in artifacts.findings_documents(f).collect()}
    for repo, doc in want.items():
        with open(files[repo].file, encoding="utf-8") as x:
            assert json.load(x) == doc
        assert files[repo].n_findings == len(doc["vulnerabilities"])
    rows, errors = documents.read_artifact(spark, "findings", out)
    assert {r.repo_id: r["count"] for r in rows.groupBy("repo_id").count().collect()} == {k: v.n_findings for k, v in files.items()}
    assert errors.count() == 0 and set(files) == set(want)
    again = documents.export_findings(f.filter("repo_id = 'small'"), out)
    assert [r.repo_id for r in again.collect()] == ["small"] and len(os.listdir(out)) == 3
    assert documents.export_findings(f.limit(0), _folder("none")).count() == 0


def test_report_files(spark):
    docs = spark.createDataFrame([("a.json", json.dumps({"content": "# A\né"})), ("b.json", json.dumps({"content": ""})), ("c.json", "[]"),
                                  ("d e.json", json.dumps({"content": "x"}))], "file_name string, json string")
    out = _folder("md")
    assert documents.write_report_files(artifacts.export_reports(docs), out).count() == 3
    assert sorted(os.listdir(out)) == ["a.md", "b.md", "d e.md"]
    with open(os.path.join(out, "a.md"), encoding="utf-8") as f:
        assert f.read() == "# A\né"
