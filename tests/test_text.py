"""T1 T2 F6-F11 on the text cases of FIXTURES.md."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codesift.functions import text as tx
from conftest import one_col

TEXTS = ["", "no newline", "trailing\n", "a\r\nb", "a\rb\rc", "x\u00a0y", "p\u0085q", "z\u200bw", "emoji 😀 ok",
         "  lead and trail  ", "tab\tsep", "a\n\n\nb\n"]


def _py_lines(t):
    t = t.replace("\r\n", "\n").replace("\r", "\n")
    parts = t.split("\n")
    return parts[:-1] if parts[-1] == "" else parts


def test_collapse_matches_python(spark):
    for x, y in one_col(spark, TEXTS).select("x", tx.collapse_ws("x")).collect():
        assert y == " ".join(x.split()), repr(x)


def test_split_lines(spark):
    for x, y in one_col(spark, TEXTS).select("x", tx.split_lines("x")).collect():
        assert y == _py_lines(x), repr(x)


def test_loc_tokens_sha1(spark):
    rows = one_col(spark, TEXTS).select("x", tx.loc("x"), tx.token_estimate("x"), tx.sha1_hex("x"),
                                        tx.head_chars("x", 3)).collect()
    for x, loc, tok, sha, head in rows:
        t = x.replace("\r\n", "\n").replace("\r", "\n")
        assert loc == t.count("\n") + 1
        assert tok == int(len(t) / 4) + 1
        assert sha == hashlib.sha1(x.encode()).hexdigest()
        assert head == t[:3]


def test_decode_ignore(spark):
    df = spark.createDataFrame([(b"ok \xc3\xa9",), (b"bad \xff\xfe tail",), (None,)], "b binary")
    got = [r[0] for r in df.select(tx.decode_ignore("b")).collect()]
    assert got == ["ok é", "bad  tail", None]


def test_extract_imports(spark):
    src = ("import React from 'react'\nfrom os import path\n  import   x.y/z@1\nimport \"side-effect\"\n"
           "const a = require('b')\nfrom\n")
    got = one_col(spark, [src]).select(tx.extract_imports("x")).first()[0]
    assert got == ["React", "os", "x.y/z@1"]
    many = "\n".join(f"import m{i}" for i in range(150))
    assert len(one_col(spark, [many]).select(tx.extract_imports("x")).first()[0]) == 150
    assert len(one_col(spark, [many]).select(tx.extract_imports("x", 100)).first()[0]) == 100


def test_line_range(spark):
    row = spark.range(1).select(tx.line_range(F.lit(3), F.lit(5)), tx.line_range(F.lit(2), F.lit(2))).first()
    assert row[0] == [3, 4, 5] and row[1] == [2]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\r\u00a0\u0085\u2028\u200bab\x1c", max_size=15), min_size=1, max_size=25))
def test_whitespace_property(spark, xs):
    for x, y, z in one_col(spark, xs).select("x", tx.collapse_ws("x"), tx.py_strip("x")).collect():
        assert y == " ".join(x.split())
        assert z == x.strip()
