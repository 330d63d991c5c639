"""F1-F5 and listing helpers on the path cases of FIXTURES.md."""

import re
from pathlib import PurePosixPath

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codesift.functions import paths
from conftest import one_col

PATH_CASES = [".env", ".gitignore", "__init__.py", "_app.js", "__tests__/t.js", "a.tar.gz", "foo.", "..x",
              "Makefile", "a/b.JS", "test/a.js", "x/test/a.js", "src/licenseService.js", "C:\\a\\b", "/C:/z",
              "//x//y", "a/b/c/d/e/f/g.py"]


def test_language_golden(spark):
    got = dict(one_col(spark, PATH_CASES).select("x", paths.detect_language("x")).collect())
    assert got["a.tar.gz"] == "gz"
    assert got[".gitignore"] == "" and got["foo."] == "" and got["Makefile"] == "" and got[".env"] == ""
    assert got["..x"] == "x"
    assert got["a/b.JS"] == "js"          # mapped case-insensitively
    assert got["__init__.py"] == "python"
    assert got["a/b/c/d/e/f/g.py"] == "python"


def test_suffix_matches_pathlib(spark):
    rows = one_col(spark, PATH_CASES).select("x", paths.suffix("x")).collect()
    for p, sfx in rows:
        if "\\" in p:
            continue
        assert sfx == PurePosixPath(p).suffix, p


def test_normalize_golden(spark):
    got = dict(one_col(spark, PATH_CASES + [None]).select("x", paths.normalize_rel("x")).collect())
    assert got["C:\\a\\b"] == "a/b"
    assert got["/C:/z"] == "C:/z"      # drive removed before leading slashes
    assert got["//x//y"] == "x/y"
    assert got[None] == ""


def test_prefilter_traps(spark):
    got = dict(one_col(spark, PATH_CASES + ["README", "docs/x.md", "a/fixtures/b.js", "LICENſE"])
               .select("x", paths.path_prefilter_match("x")).collect())
    assert got["test/a.js"] is False          # top-level test/ has no leading slash
    assert got["x/test/a.js"] is True
    assert got["src/licenseService.js"] is True   # bare LICENSE matches anywhere
    assert got["__tests__/t.js"] is False     # needs a slash before __tests__
    assert got["README"] is True and got["docs/x.md"] is True and got["a/fixtures/b.js"] is True
    assert got["LICENſE"] is True             # Unicode case folding, as Python's re


def test_parts_and_join(spark):
    df = one_col(spark, ["a/./b//c", "../x", "", "/abs/p"])
    got = {r[0]: (r[1], r[2]) for r in df.select("x", paths.path_parts("x"),
                                                  paths.join_base(F.lit("/base"), F.col("x"))).collect()}
    assert got["a/./b//c"] == (["a", "b", "c"], "/base/a/b/c")
    assert got["../x"] == (["..", "x"], None)     # parent escapes are rejected
    assert got[""] == ([], "/base")
    assert got["/abs/p"] == (["abs", "p"], "/base/abs/p")


def test_relativize(spark):
    df = one_col(spark, ["/repo/src/a.js", "/other/b.js", "/repo", "rel/c.js"])
    got = dict(df.select("x", paths.relativize("x", "/repo")).collect())
    assert got == {"/repo/src/a.js": "src/a.js", "/other/b.js": "b.js", "/repo": ".", "rel/c.js": "c.js"}


def test_ancestors(spark):
    got = dict(one_col(spark, ["a/b/c.js", "top.js"]).select("x", paths.ancestor_dirs("x")).collect())
    assert got["a/b/c.js"] == ["", "a", "a/b"]
    assert got["top.js"] == [""]


def _py_normalize(p):
    s = p.replace("\\", "/")
    s = re.sub(r"^[A-Za-z]:[/\\]", "", s).lstrip("/")
    while "//" in s:
        s = s.replace("//", "/")
    return s


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="ab/\\:.C ", max_size=12), min_size=1, max_size=20))
def test_normalize_property(spark, xs):
    rows = one_col(spark, xs).select("x", paths.normalize_rel("x")).collect()
    for x, y in rows:
        assert y == _py_normalize(x), x
