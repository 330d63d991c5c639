"""The literal screen gives the same rows as running every rule on every line."""

import random

from pyspark.sql import functions as F

from codesift.functions.text import split_lines
from codesift.operators import rules


def test_required_literals():
    needed = rules.required_literals
    assert needed("(?i)<Script") == ["<script"]
    assert needed("innerHTML|dangerouslySetInnerHTML") == ["dangerouslysetinnerhtml", "innerhtml"]
    assert needed(r"\b[0-9a-f]{40}\b") == [] and needed("a|bcd") == [] and needed("(?:eval)?x") == []
    assert needed(r"(?i)select .* from .*['\"] *\+") == ["select "]
    assert needed(r"foo(?:barbar)+\bqux") == ["barbar"] and needed(r"ab\bcd") == ["abcd"]
    assert needed(r"(?iu)secret") == [] and needed(r"\p{L}secret") == [] and needed("(") == [] and needed(r"\vsecret") == []
    assert needed("(?!secret)public") == ["public"] and needed("(?=secret)") == []


def plainly(files, table):
    """Every rule on every line."""
    lines = files.select("repo_id", "path", F.posexplode_outer(split_lines(F.col("text"))).alias("i", "code")).filter("i IS NOT NULL")
    return lines.crossJoin(table).filter(F.expr("code RLIKE pattern")).select("repo_id", "path", F.col("i") + 1, "rule_id", "code")


def test_five_thousand_rules_from_a_table(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdeXYZ_", k=rng.randint(3, 7))) for _ in range(1500)]
    patterns = []
    for i in range(5000):
        w, v = rng.choice(words), rng.choice(words)
        patterns.append(rng.choice([w, f"(?i){w}", rf"\b{w}\b", f"{w}.*{v}", f"{w}|{v}", f"(?:{w})+{v[:2]}?", f"^{w}"]))
    patterns += [r"[0-9]{6}", "(?iu)straße", None]
    table = spark.createDataFrame([(f"r{i}", p, "p", "v", "Low") for i, p in enumerate(patterns)],
                                  "rule_id string, pattern string, pipeline_id string, vulnerability string, severity string")
    texts = ["\r\n".join(" ".join(rng.choices(words, k=3)) for _ in range(8)) + rng.choice(["", "\n", "\r\rX 123456", "\nSTRASSE straße"])
             for _ in range(12)] + ["", None, "İ" + words[0].upper() + " " + words[1]]
    files = spark.createDataFrame([("r", f"f{i}", t) for i, t in enumerate(texts)], "repo_id string, path string, text string") \
        .withColumn("rule_no", F.lit(1))
    got = [(r.repo_id, r.file_path, r.line_no, r.rule_id, r.code_snippet) for r in rules.screen_rules(files, table).collect()]
    want = [tuple(r) for r in plainly(files, table).collect()]
    assert sorted(got) == sorted(want) and len(got) > 500


def test_no_rules(spark):
    files = spark.createDataFrame([("r", "f", "x")], "repo_id string, path string, text string")
    assert rules.screen_rules(files, []).count() == 0
    assert rules.screen_rules(files, []).columns == rules.screen_rules(files).columns
