"""S1 by a frontier: the same paths as a plain walk, whatever the slices and budgets; large directories by many tasks."""

import os
import tempfile

from codesift.functions.paths import TREE_EXCLUDE_DIRS
from codesift.sources import listing


def _plain(root, depth, exclude):
    out = []
    for here, dirs, files in os.walk(root, followlinks=True):
        rel = os.path.relpath(here, root)
        level = 0 if rel == "." else rel.count("/") + 1
        dirs[:] = [d for d in dirs if d not in exclude and (depth is None or level < depth)]
        out += [f if rel == "." else f"{rel}/{f}" for f in files]
    return sorted(out)


def _tree(base):
    for i in range(300):
        folder = os.path.join(base, f"d{i % 7}", f"e{i % 3}", "node_modules" if i % 50 == 0 else f"f{i % 5}")
        os.makedirs(folder, exist_ok=True)
        open(os.path.join(folder, f".h{i}" if i % 9 == 0 else f"é {i}.js"), "w").close()
    os.makedirs(os.path.join(base, "empty"))
    open(os.path.join(base, "top"), "w").close()
    os.symlink(os.path.join(base, "d1"), os.path.join(base, "link"))
    os.symlink(os.path.join(base, "nowhere"), os.path.join(base, "broken"))


def test_equals_a_plain_walk(spark):
    base = tempfile.mkdtemp(prefix="codesift-walk-")
    _tree(base)
    roots = spark.createDataFrame([("r", base), ("none", base + "/missing"), ("null", None)], "repo_id string, root string")
    for depth, cut in [(None, {}), (2, {}), (0, {}), (None, {"slice_entries": 4, "row_entries": 10}), (3, {"slice_entries": 1, "row_entries": 1})]:
        rows = listing.walk_rounds(roots, depth, **cut).filter("kind = 'file'").collect()
        assert sorted(r.path for r in rows) == _plain(base, depth, TREE_EXCLUDE_DIRS), (depth, cut)
        assert {(r.repo_id, r.root) for r in rows} == {("r", base)}
    every = listing.list_files(roots, exclude_dirs=[])
    assert sorted(r.path for r in every.collect()) == _plain(base, None, [])


def test_one_directory_by_many_tasks(spark):
    base = tempfile.mkdtemp(prefix="codesift-walk-")
    for i in range(200_000):
        os.close(os.open(os.path.join(base, f"f{i}"), os.O_CREAT))
    rows = listing.walk_rounds(spark.createDataFrame([("r", base)], "repo_id string, root string")).filter("kind = 'file'")
    assert rows.count() == rows.select("path").distinct().count() == 200_000
    assert rows.select("task").distinct().count() > 1 and rows.groupBy("parts", "task").count().count() > 1


def test_flatten_leaves_no_view(spark):
    trees = spark.createDataFrame([("r", '{"src": {"__files__": ["a.js"]}, "__files__": ["b"]}')], "repo_id string, tree_json string")
    before = {t.name for t in spark.catalog.listTables()}
    flat = listing.flatten_tree(trees)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert sorted(r.path for r in flat.collect()) == ["b", "src/a.js"]
