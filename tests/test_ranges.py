"""J1 by directory ranges: equal to a prefix test of every (file, directory) pair; rows do not grow with depth."""

import random

from codesift.operators import metadata, ranges


def _expected(files, sel):
    below, full = {}, set()
    for repo, path in files:
        for r, d, pos in sel:
            if r == repo and (d == "" or path.startswith(d + "/")):
                below[repo, path] = min(pos, below.get((repo, path), pos))
                full.add((r, d))
    return below, full


def test_equals_prefix_tests(spark):
    rnd = random.Random(5)
    names = ["a", "a-b", "a0", "a.b", "b", "é", "z", "A", "a b"]
    def path(n):
        return "/".join(rnd.choice(names) for _ in range(n))
    for case in range(4):
        files = sorted({(rnd.choice(["hot", "hot", "hot", "cold", "cö"]), path(rnd.randint(1, 5)) + rnd.choice([".js", "", "0"])) for _ in range(600)})
        dirs = {(rnd.choice(["hot", "cold", "none"]), path(rnd.randint(1, 4))) for _ in range(60)}
        if case % 2:
            dirs |= {("hot", ""), ("none", "")}
        sel = [(r, d, p) for p, (r, d) in enumerate(rnd.sample(sorted(dirs), len(dirs)))]
        below, full = ranges.files_below(spark.createDataFrame(files, "repo_id string, path string").repartition(5),
                                         spark.createDataFrame(sel, "repo_id string, dir string, pos long"))
        want_below, want_full = _expected(files, sel)
        assert {(r.repo_id, r.path): r.pos for r in below.collect()} == want_below
        assert {(r.repo_id, r.dir) for r in full.collect()} == want_full


def test_rows_do_not_grow_with_depth(spark):
    deep = "/".join(f"d{i}" for i in range(50))
    files = spark.createDataFrame([("r", f"{deep}/f{i}.js") for i in range(200)], "repo_id string, path string")
    dirs = spark.createDataFrame([("r", "/".join(deep.split("/")[:n]), 100 - n) for n in (1, 10, 50)], "repo_id string, dir string, pos long")
    assert ranges.sweep_rows(files, dirs).count() == 200 + 2 * 3
    below, full = ranges.files_below(files, dirs)
    assert {(r.pos, r["count"]) for r in below.groupBy("pos").count().collect()} == {(50, 200)} and full.count() == 3


def test_empty_null_and_repeated(spark):
    files = spark.createDataFrame([("r", "a/x"), ("r", "a/x"), (None, "a/y"), ("r", None)], "repo_id string, path string")
    sel = spark.createDataFrame([("r", 2, "a"), ("r", 1, "a/"), ("r", 3, "b"), (None, 4, "a"), ("r", 5, ".")], "repo_id string, pos long, path string")
    exp, missing = metadata.expand_selection(sel, files)
    assert [(r.repo_id, r.path, r.pos, r.sub_path) for r in exp.collect()] == [("r", "a/x", 1, "a/x")]
    assert sorted((str(r.repo_id), r.pos, r.path) for r in missing.collect()) == [("None", 4, "a"), ("r", 3, "b")]
    exp, missing = metadata.expand_selection(sel.limit(0), files)
    assert exp.count() == missing.count() == 0
    exp, missing = metadata.expand_selection(sel, files.limit(0))
    assert exp.count() == 0 and missing.count() == 5
