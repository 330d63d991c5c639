"""Golden tables for the joins, windows and sources."""

import json
import os
import tempfile

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from codesift.operators import grouping, metadata, ordering, rules, scan
from codesift.operators.selection import read_selection
from codesift.plans import model
from codesift.plans.catalog import catalog_frame
from codesift.sources import listing

FILES = [("r", p) for p in ["src/a.js", "src/b/c.js", "src/node_modules/x.js", "lib/d.py", "top.js"]]


def test_expand_selection(spark):
    files = spark.createDataFrame(FILES, "repo_id string, path string")
    sel = spark.createDataFrame([("r", 1, "src"), ("r", 2, "lib/d.py"), ("r", 3, "src/a.js"), ("r", 4, "nope.js"),
                                 ("r", 5, "/top.js")], "repo_id string, pos long, path string")
    exp, missing = metadata.expand_selection(sel, files)
    got = sorted((r.pos, r.sub_path, r.path) for r in exp.collect())
    # the folder re-admits node_modules (expansion uses the unfiltered listing); a.js keeps its first position
    assert got == [(1, "src/a.js", "src/a.js"), (1, "src/b/c.js", "src/b/c.js"),
                   (1, "src/node_modules/x.js", "src/node_modules/x.js"), (2, "", "lib/d.py"), (5, "", "top.js")]
    assert [tuple(r) for r in missing.collect()] == [("r", 4, "nope.js")]


def test_changes_and_upsert(spark):
    cols = "repo_id string, path string, kind string, language string, side string, loc long, imports array<string>, " \
           "description string, sha1 string, token_estimate long, ord long"
    prev = spark.createDataFrame([
        ("r", "same.js", "file", "js", "", 1, ["a"], "kept", "h1", 1, 1),
        ("r", "edit.js", "file", "js", "", 1, [], "old", "h2", 1, 2),
        ("r", "nodesc.js", "file", "js", "", 1, [], None, "h3", 1, 3),
        ("r", "gone.js", "file", "js", "", 1, [], "stays", "h4", 1, 4),
    ], cols)
    cur = spark.createDataFrame([("r", "same.js", "h1"), ("r", "edit.js", "hX"), ("r", "nodesc.js", "h3"),
                                 ("r", "new.js", "h5")], "repo_id string, path string, sha1 string")
    ch = {r.path: r.change for r in metadata.detect_changes(cur, prev).collect()}
    assert ch == {"same.js": "unchanged", "edit.js": "changed", "nodesc.js": "changed", "new.js": "new"}
    upd = spark.createDataFrame([("r", "edit.js", "file", "js", "", 2, [], "fresh", "hX", 2, None, 5),
                                 ("r", "new.js", "file", "js", "", 2, [], "n", "h5", 2, None, 9)],
                                cols + ", _order_pos long")
    out = {r.path: (r.ord, r.description) for r in metadata.upsert_metadata(prev, upd).collect()}
    assert out == {"same.js": (1, "kept"), "edit.js": (2, "fresh"), "nodesc.js": (3, None), "gone.js": (4, "stays"),
                   "new.js": (5, "n")}


def test_ordinal_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), F.sha1(F.col("id").cast("string")).alias("k"))
    df = df.withColumn("g", F.when(F.col("k") < "c", F.lit(0)).otherwise(F.col("g")))  # one hot group
    got = ordering.ordinal(df, ["g"], ["k"], "n")
    ref = df.withColumn("m", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    diff = got.join(ref, ["g", "k"]).filter(F.col("n") != F.col("m")).count()
    assert diff == 0 and got.count() == 5000


def test_head_n_and_distinct_first(spark):
    df = spark.createDataFrame([("r", p, i) for i, p in enumerate(["c", "a", "b", "a", "d"])], "repo_id string, path string, pos int")
    top = ordering.head_n(df.dropDuplicates(["path"]), 2, ["repo_id"], ["path"])
    assert sorted((r.path, r.n_total) for r in top.collect()) == [("a", 4), ("b", 4)]
    first = ordering.distinct_first(df, ["repo_id", "path"], ["pos"])
    assert sorted((r.path, r.pos) for r in first.collect()) == [("a", 1), ("b", 2), ("c", 0), ("d", 4)]


def test_chunks(spark):
    meta = spark.createDataFrame([("r", f"p{i:03d}", i) for i in range(130)], "repo_id string, path string, ord long")
    c = grouping.assign_chunks(meta, 60)
    sizes = sorted((r.chunk, r["count"]) for r in c.groupBy("chunk").count().collect())
    assert sizes == [(1, 60), (2, 60), (3, 10)]
    assert c.filter("path = 'p060'").first().pos_in_chunk == 0


def test_plan_runs(spark):
    subsets = spark.createDataFrame([("r", 1, "subset-001", ["a"]), ("r", 2, "subset-002", ["b", "c"])],
                                    "repo_id string, subset_no int, subset_id string, file_paths array<string>")
    sugg = spark.createDataFrame([("r", 1, "subset-001", ["pipeline_xss", "zzz"]), ("r", 3, "subset-009", ["pipeline_auth"])],
                                 "repo_id string, subset_no int, subset_id string, suggested_pipelines array<string>")
    plan = scan.plan_runs(sugg, subsets, catalog_frame(spark))
    got = sorted((r.subset_id, r.pipeline_pos, r.pipeline_id, r.plan_status) for r in plan.collect())
    assert got == [("subset-001", 0, "pipeline_xss", "ok"), ("subset-001", 1, "zzz", "unknown_pipeline"),
                   ("subset-009", 0, "pipeline_auth", "unknown_subset")]


def test_bundle_cut(spark):
    subsets = spark.createDataFrame([("r", "s", ["a", "missing", "b", "a"])],
                                    "repo_id string, subset_id string, file_paths array<string>")
    files = spark.createDataFrame([("r", "a", "AAA"), ("r", "b", "B")], "repo_id string, path string, text string")
    part = lambda p, t: f"\n=====\nFILE: {p}\n=====\n{t}\n=====\nEND OF FILE: {p}\n=====\n"
    full = "\n".join([part("a", "AAA"), part("b", "B"), part("a", "AAA")])
    b = scan.bundle_context(subsets, files).first()
    assert b.bundle == full and b.n_parts == 3
    for cut in [5, len(part("a", "AAA")), len(part("a", "AAA")) + 1, len(full) - 1, len(full) + 10]:
        assert scan.bundle_context(subsets, files, max_chars=cut).first().bundle == full[:cut]


def test_read_selection(spark):
    docs = spark.createDataFrame([
        ("a", json.dumps({"files_to_analyze": ["x", "y"], "folders_to_analyze": ["z"]})),
        ("b", json.dumps({"files_to_analyze": []})),
        ("c", json.dumps({"folders_to_analyze": ["f"], "standalone_files": ["s"]})),
        ("d", json.dumps(["l1"])),
    ], "repo_id string, json string")
    got = sorted(tuple(r) for r in read_selection(docs).collect())
    assert got == [("a", 1, "x"), ("a", 2, "y"), ("c", 1, "f"), ("c", 2, "s"), ("d", 1, "l1")]


def test_flatten_tree(spark):
    tree = {"src": {"__files__": ["a.js"], "coverage": {"__files__": ["c.js"]}, "deep": {"x": {"__files__": ["d.js"]}}},
            "__files__": ["root.js"], "node_modules": {"__files__": ["n.js"]}, "weird": 5}
    docs = spark.createDataFrame([("r", json.dumps(tree))], "repo_id string, tree_json string")
    got = sorted(r.path for r in listing.flatten_tree(docs).collect())
    assert got == ["root.js", "src/a.js", "src/deep/x/d.js"]


def test_list_files_keeps_hidden(spark):
    root = tempfile.mkdtemp(prefix="codesift-tree-")
    for rel in [".env", "__init__.py", "_app.js", "__tests__/t.js", ".github/w.yml", "ok.py", "node_modules/m.js",
                "a/b/c/deep.js"]:
        os.makedirs(os.path.dirname(os.path.join(root, rel)) or root, exist_ok=True)
        with open(os.path.join(root, rel), "w") as fh:
            fh.write(rel)
    roots = spark.createDataFrame([("r", root)], "repo_id string, root string")
    got = sorted(r.path for r in listing.list_files(roots, depth=2).collect())
    assert got == [".env", ".github/w.yml", "__init__.py", "__tests__/t.js", "_app.js", "ok.py"]
    content = listing.read_contents(listing.list_files(roots, depth=6)).filter("path = '.env'").first().content
    assert bytes(content) == b".env"


def test_tree_edges(spark):
    files = spark.createDataFrame([("r", "a/b.js"), ("r", "a/c/d.js"), ("r", "e.js")], "repo_id string, path string")
    got = sorted((r.parent, r.name, r.kind, r.depth) for r in listing.tree_edges(files).collect())
    assert got == [("", "a", "dir", 0), ("", "e.js", "file", 0), ("a", "b.js", "file", 1), ("a", "c", "dir", 1),
                   ("a/c", "d.js", "file", 2)]


def test_rules(spark):
    files = spark.createDataFrame([("r", "p.html", "<div>\n<SCRIPT src=x>\nel.innerHTML = v\n")],
                                  "repo_id string, path string, text string")
    got = sorted((r.rule_id, r.line_no) for r in rules.screen_rules(files).collect())
    assert got == [("inline_script", 2), ("inner_html", 3)]


def test_complete_with_provider_and_replay(spark):
    reqs = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "key string")
    reqs = model.with_request(reqs, "op", F.lit("sys"), F.col("key"), model.params("gpt-4o", temperature=0.1))
    stored = reqs.filter("key = 'k1'").select("request_id", F.lit("cached").alias("content"), F.lit("ok").alias("status"))
    calls = spark.sparkContext.accumulator(0)

    def provider(batches):
        for pdf in batches:
            yield pd.DataFrame({"request_id": pdf["request_id"],
                                "content": [json.loads(m)[1]["content"].upper() for m in pdf["messages_json"]],
                                "status": "ok"})

    out = {r.key: r.content for r in model.complete(reqs, provider=provider, responses=stored).collect()}
    assert out == {"k1": "cached", "k2": "K2", "k3": "K3"}
    rep = {r.key: r.status for r in model.complete(reqs, responses=stored).collect()}
    assert rep == {"k1": "ok", "k2": "missing", "k3": "missing"}
    stats = model.call_stats(model.complete(reqs, responses=stored)).first()
    assert (stats.n_requests, stats.n_missing) == (3, 2)
    p = reqs.select("params_json").first()[0]
    assert p == '{"model":"gpt-4o","temperature":0.1}'
    p5 = spark.range(1).select(F.to_json(model.params("gpt-5", temperature=0.3, max_tokens=720))).first()[0]
    assert p5 == '{"model":"gpt-5","max_completion_tokens":720,"stream":false}'
