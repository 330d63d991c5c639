"""L1 against the brute-force statement, on random and on table-derived inputs; L3 cases."""

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from codesift.operators import locate
from codesift.plans import table_queries as TQ
from codesift.session import materialize, written
from conftest import SF_SMALL

WORDS = ["const", "x", "=", "req.query.id;", "db.find(x)", "}", "{", "", "  ", "return", "user", "if", "(a)"]


def _lines(text):
    parts = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    return parts[:-1] if parts[-1] == "" else parts


def every_window(text, snippet, threshold=0.6, most=5):
    """The lines of the best of all windows: highest score, then fewest lines, then earliest."""
    lines = _lines(text)
    snip = " ".join(snippet.split())
    scored = [(SequenceMatcher(None, snip, " ".join("\n".join(lines[s:s + n]).split())).ratio(), -n, -s)
              for n in range(1, most + 1) for s in range(len(lines) - n + 1)]
    score, n, s = max(scored, default=(0.0, 0, 0))
    return [1 - s + i for i in range(-n)] if score >= threshold else []


def _random_file(rng):
    lines = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 14))]
    sep = rng.choice(["\n", "\r\n"])
    return sep.join(lines) + rng.choice(["", sep])


def _random_snippet(rng, text):
    lines = _lines(text)
    if lines and rng.random() < 0.7:
        s = rng.randrange(len(lines))
        piece = "\n".join(lines[s:s + rng.randint(1, 3)])
        chars = list(piece)
        for _ in range(rng.randint(0, 4)):  # small edits
            if chars:
                chars[rng.randrange(len(chars))] = rng.choice("xyz ;")
        return "".join(chars)
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 5)))


def test_matches_brute_force(spark):
    rng = random.Random(7)
    files, finds, expect = [], [], {}
    for i in range(60):
        text = _random_file(rng)
        files.append(("r", f"f{i}.js", text))
        for j in range(3):
            snip = _random_snippet(rng, text)
            fid = f"{i}-{j}"
            finds.append((fid, "r", f"f{i}.js", snip))
            expect[fid] = every_window(text, snip)
    fdf = spark.createDataFrame(files, "repo_id string, path string, text string")
    sdf = spark.createDataFrame(finds, "finding_id string, repo_id string, path string, snippet string")
    got = {r.finding_id: r.line for r in locate.locate_snippets(sdf, fdf).collect()}
    assert got == expect


def test_unknown_file_and_null_snippet(spark):
    fdf = spark.createDataFrame([("r", "a.js", "x = 1\n")], "repo_id string, path string, text string")
    sdf = spark.createDataFrame([("1", "r", "missing.js", "x = 1"), ("2", "r", "a.js", None), ("3", "r", "a.js", "x=1")],
                                "finding_id string, repo_id string, path string, snippet string")
    got = {r.finding_id: r.line for r in locate.locate_snippets(sdf, fdf).collect()}
    assert got == {"1": [], "2": [], "3": every_window("x = 1\n", "x=1")}


def test_ties_prefer_small_window_then_early_start(spark):
    text = "a\n\nb\na\n"
    fdf = spark.createDataFrame([("r", "t", text)], "repo_id string, path string, text string")
    sdf = spark.createDataFrame([("1", "r", "t", "a"), ("2", "r", "t", ""), ("3", "r", "t", "a b")],
                                "finding_id string, repo_id string, path string, snippet string")
    got = {r.finding_id: r.line for r in locate.locate_snippets(sdf, fdf).collect()}
    assert got == {"1": [1], "2": [2], "3": [1, 2, 3]}  # blank line 2 joins "a" and "b"
    for fid, snip in [("1", "a"), ("2", ""), ("3", "a b")]:
        assert got[fid] == every_window(text, snip)


def test_blocks_agree_with_one_block(spark, monkeypatch):
    rng = random.Random(11)
    text = "\n".join(" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 5))) for _ in range(90))
    finds = [(str(i), "r", "f", _random_snippet(rng, text)) for i in range(25)]
    fdf = spark.createDataFrame([("r", "f", text)], "repo_id string, path string, text string")
    sdf = spark.createDataFrame(finds, "finding_id string, repo_id string, path string, snippet string")
    monkeypatch.setattr(locate, "BLOCK_LINES", 7)
    got = {r.finding_id: r.line for r in locate.locate_snippets(sdf, fdf).collect()}
    assert got == {i: every_window(text, snip) for i, _, _, snip in finds}


def test_edited_snippets_of_whole_documents(spark):
    files = TQ._with_text(TQ._files(spark, SF_SMALL)).filter("length(text) < 1500").select("repo_id", "path", "text", "doc_id")
    rows = files.collect()
    finds = [(str(r.doc_id), r.repo_id, r.path, "".join(c for i, c in enumerate(_lines(r.text)[r.doc_id % len(_lines(r.text))]) if i % 5 != 4))
             for r in rows]
    sdf = spark.createDataFrame(finds, "finding_id string, repo_id string, path string, snippet string")
    got = {r.finding_id: r.line for r in locate.locate_snippets(sdf, files).collect()}
    texts = {str(r.doc_id): r.text for r in rows}
    assert got == {i: every_window(texts[i], snip) for i, _, _, snip in finds}


def test_relocate_cases(spark):
    fdf = spark.createDataFrame([("r", "a.js", "one\ntwo\nthree\n")], "repo_id string, path string, text string")
    stored = spark.createDataFrame([
        ("r", "1", "a.js", "two", [2]),        # unchanged
        ("r", "2", "a.js", "three", [1]),      # changed
        ("r", "3", "a.js", "☃☃☃☃", [3]),       # not found, had lines -> changed row with []
        ("r", "4", "a.js", "☃☃☃☃", []),        # not found, no lines
        ("r", "5", "a.js", None, [1]),         # no snippet: total only
    ], "repo_id string, finding_id string, file_path string, code_snippet string, line array<int>")
    res = locate.relocate_diff(stored, fdf)
    s = res["summary"].first()
    assert (s.total_vulnerabilities, s.changed_count, s.unchanged_count, s.not_found_count) == (5, 2, 1, 2)
    rows = {r.finding_id: (r.old_line, r.new_line) for r in res["changed"].collect()}
    assert rows == {"2": ([1], [3]), "3": ([3], [])}


def test_similarity_not_symmetric(spark):
    df = spark.createDataFrame([("tide", "diet")], "a string, b string")
    r = df.select(locate.similarity(F.col("a"), F.col("b")), locate.similarity(F.col("b"), F.col("a"))).first()
    assert (r[0], r[1]) == (0.25, 0.5)


def _n_windows(text, most=5):
    n = len(_lines(text))
    return sum(max(n - w + 1, 0) for w in range(1, most + 1))


def test_bounds_are_never_below_the_ratio(spark):
    rng = random.Random(5)
    odd = ["Straße İstanbul ΑΣ", "Kelvin K", "a\u00a0b", "ﬁne ǅ", "e\u0301", "漢字 かな", "tab\tand  blanks", "ABC abc"]
    files, finds = [], []
    for i in range(30):
        text = "\n".join([_random_file(rng), *rng.sample(odd, 4)])
        files.append(("r", f"f{i}", text))
        finds.append((str(i), "r", f"f{i}", _random_snippet(rng, text) + rng.choice(odd)))
    texts = {p: t for _, p, t in files}
    blocks = locate.file_blocks(spark.createDataFrame(files, "repo_id string, path string, text string"), 5)
    wanted = spark.createDataFrame(finds, "finding_id string, repo_id string, path string, snip string") \
        .withColumn("snip", locate.collapse_ws("snip")).withColumn("snip_counts", locate.histogram(F.col("snip")))
    rows = locate.with_text(locate.window_bounds(blocks.drop("lines").join(wanted, ["repo_id", "path"]), 5, 0.0), blocks).collect()
    assert len(rows) == sum(_n_windows(t) for t in texts.values())
    for r in rows:
        lines = _lines(texts[r.path])
        assert r.window == " ".join("\n".join(lines[r["at"]:r["at"] + r.w]).split())
        assert r.bound >= SequenceMatcher(None, r.snip, r.window).ratio()


def _sent(spark, f, files):
    """(findings, windows sent to Python, all windows) of ``f(finding_id, repo_id, path, snippet)``."""
    wanted = materialize(f.withColumn("snip", locate.collapse_ws("snippet")).drop("snippet")
                         .withColumn("snip_counts", locate.histogram(F.col("snip"))))
    blocks = materialize(locate.file_blocks(files, 5))
    first = locate.most_likely_windows(wanted, blocks, 0.6, 5)
    best = materialize(locate._score(first, F.lit(0.0)))
    sent = first.count() + locate.remaining_windows(wanted, best, blocks, 0.6, 5).count()
    texts = files.join(wanted.select("repo_id", "path"), ["repo_id", "path"]).select("text")
    return wanted.count(), sent, sum(_n_windows(r.text) for r in texts.collect())


def test_few_windows_reach_python(spark):
    """Windows built as text and scored are below a tenth of all windows, for the registered query's snippets and for
    edited lines.  (From 200 characters on, difflib ignores frequent characters and scores fall far below any
    bound on characters, so the second table has shorter windows only.)"""
    files = TQ._with_text(TQ._files(spark, SF_SMALL)).select("repo_id", "path", "text")
    lines = TQ._locate_findings(spark, SF_SMALL)
    n, sent, every = _sent(spark, TQ._fuzzy_findings(lines).select("finding_id", "repo_id", "path", "snippet"), files)
    assert n <= sent < every / 10

    rng = random.Random(3)
    short = [("r", f"f{i}", "\n".join(" ".join("".join(rng.choices("etaoinshrdlucmf", k=rng.randint(2, 7))) for _ in range(rng.randint(3, 6)))
                                    for _ in range(60))) for i in range(20)]
    finds = [(f"{i}-{j}", "r", f"f{i}", "".join(c for k, c in enumerate(t.split("\n")[j * 11]) if k % 7 != 6))
             for i, (_, _, t) in enumerate(short) for j in range(4)]
    n, sent, every = _sent(spark, spark.createDataFrame(finds, "finding_id string, repo_id string, path string, snippet string"),
                           spark.createDataFrame(short, "repo_id string, path string, text string"))
    assert n <= sent < every / 10


def test_exact_snippets_are_scored_once(spark):
    text = "\n".join(["same line"] * 400 + ["other line"])
    fdf = spark.createDataFrame([("r", "f", text)], "repo_id string, path string, text string")
    wanted = spark.createDataFrame([("1", "r", "f", "other line"), ("2", "r", "f", "same line")],
                                   "finding_id string, repo_id string, path string, snip string") \
        .withColumn("snip_counts", locate.histogram(F.col("snip")))
    blocks = locate.file_blocks(fdf, 5)
    first = locate.most_likely_windows(wanted, blocks, 0.6, 5)
    assert first.count() == 2
    assert locate.remaining_windows(wanted, locate._score(first, F.lit(0.0)), blocks, 0.6, 5).count() == 0


def test_exact_snippets_are_not_counted(spark, monkeypatch):
    """Findings that occur as whole lines are settled by comparing strings: only files of the others get histograms."""
    rng = random.Random(13)
    texts = {f"f{i}": "\n".join([*(" ".join(rng.choice(["a", "b", "", "a b"]) for _ in range(rng.randint(0, 2))) for _ in range(12)), "", "end"])
             for i in range(8)}
    finds = []
    for path, text in texts.items():
        lines = _lines(text)
        for j, n in enumerate((1, 2, 3, 5)):
            at = rng.randrange(len(lines) - n)
            finds.append((f"{path}-{j}", "r", path, "\n".join(lines[at:at + n])))
        finds.append((f"{path}-blank", "r", path, " \n"))
    finds.append(("edited", "r", "f3", "a c b"))
    fdf = spark.createDataFrame([("r", *x) for x in texts.items()], "repo_id string, path string, text string")
    sdf = spark.createDataFrame(finds, "finding_id string, repo_id string, path string, snippet string")
    counted, with_sums = [], locate.with_sums

    def spy(blocks):
        counted.extend(r.path for r in blocks.select("path").distinct().collect())
        return with_sums(blocks)

    monkeypatch.setattr(locate, "with_sums", spy)
    monkeypatch.setattr(locate, "BLOCK_LINES", 4)
    got = {r.finding_id: r.line for r in locate.locate_snippets(sdf, fdf).collect()}
    assert got == {i: every_window(texts[p], snip) for i, _, p, snip in finds} and counted == ["f3"]


def test_ratio_is_difflibs():
    rng = random.Random(17)
    for _ in range(1500):
        letters = rng.choice(["ab", "abc ", "etaoin shrdlu", "etaoin shrdlucmfwypvbgkjqxz0123456789(){}☃é"])
        x, y = ("".join(rng.choices(letters, k=rng.choice([0, 1, 30, 199, 200, 260]))) for _ in range(2))
        if rng.random() < 0.7:  # an edited text, turned
            x = "".join(rng.choice(letters) if rng.random() < 0.1 else c for c in y if rng.random() < 0.95)
            x = x[len(x) // 3:] + x[:len(x) // 3] if rng.random() < 0.3 else x
        assert locate.ratio(x, y) == SequenceMatcher(None, x, y).ratio()


def test_shuffled_texts_do_not_stay(spark):
    """What a step has moved goes when its table is written, not when the driver happens to collect garbage."""
    def shuffled():
        store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (store.apply(i).getName() for i in range(store.size())) if name.endswith(".data")}

    before, key = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    dealt = spark.range(20_000).selectExpr("id", "sha2(string(id), 256) text").repartition(4, "id")
    dealt.write.format("noop").mode("overwrite").save()
    assert shuffled() - before
    before, held = shuffled(), spark.conf.get(key, None)
    out = written(dealt.repartition(3, "text"), "dealt")
    assert not shuffled() - before
    assert out.count() == 20_000
    assert spark.conf.get(key, None) == held
