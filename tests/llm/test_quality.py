import math
import re
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from codesift.llm import host_rules, rule_ensemble
from codesift.llm.queries import q_rule_ensemble
from llm_data import corpus, empty, frame


def repeated(words):
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    return len(covered)


def test_counts(spark):
    rows = corpus()
    got = {(r.doc_id, r.n_words, r.n_repeat_words, r.n_dup_lines, r.n_symbols) for r in host_rules.judge(frame(spark, rows)).collect()}
    want = set()
    for doc_id, text, *_ in rows:
        words = (text or "").split()
        lines = [x for x in (text or "").split("\n") if x.split()]
        want.add((doc_id, len(words), repeated(words), len(lines) - len(set(lines)), sum(c in "#*$%&|<>" for c in text or "")))
    assert got == want


def test_hosts(spark):
    good = "these are plain words that make up a sentence which is long enough to pass every rule we have in this test"
    rows = [(i, good, "good", "s") for i in range(60)] + [(100 + i, "too short", "bad", "s") for i in range(50)]
    rows += [(200 + i, good, "bad", "s") for i in range(5)] + [(300, good, None, "s"), (301, None, None, "s"), (302, "too short", "small", "s")]
    got = {r.doc_id: r for r in host_rules.judge(frame(spark, rows)).collect()}
    assert all(got[i].kept for i in range(60)) and got[300].kept
    assert not any(got[i].kept for i in range(200, 205)) and not any(got[i].base_failed for i in range(200, 205))
    kept = host_rules.keep_documents(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert host_rules.judge(empty(spark)).count() == 0 and host_rules.keep_documents(empty(spark)).count() == 0


def test_shrinkage_pulls_small_hosts_to_the_corpus(spark):
    rows = [(f"h{i}", 200, 20 + i % 3, 0, 0) for i in range(30)] + [("one", 1, 1, 0, 0)]
    df = spark.createDataFrame(rows, "host string, n long, a long, b long, c long")
    measured = df.select("host", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"), "a") \
        .select("host", (F.col("i") <= F.col("a")).alias("fail_base"), F.lit(False).alias("fail_symbols"), F.lit(False).alias("fail_lines"))
    got = {r.host: r for r in host_rules.host_verdicts(measured).collect()}
    assert not got["one"].rejected and got["one"].rate_fail_base < 0.4
    assert not any(r.rejected for r in got.values())


def test_rules_learn_and_compile(spark):
    rng = np.random.default_rng(0)
    x = rng.random((800, len(rule_ensemble.STATISTICS)))
    y = ((x[:, 2] > 0.4) & (x[:, 6] <= 0.7)).astype(int)
    model = rule_ensemble.fit(x, y)
    assert 0 < len(model.rules) < 80
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:50]], rule_ensemble.STATISTICS)
    scores = [r[0] for r in df.select(model.score()).collect()]
    for row, score in zip(x, scores):
        total = model.intercept
        for weight, rule in model.rules:
            if all((row[rule_ensemble.STATISTICS.index(n)] > t) == g for n, g, t in rule):
                total += weight
        assert abs(score - 1 / (1 + math.exp(-total))) < 1e-9
    assert np.mean([(s >= 0.5) == bool(v) for s, v in zip(scores, y)]) > 0.95


def test_fit_without_labels_or_with_one_class():
    k = len(rule_ensemble.STATISTICS)
    assert rule_ensemble.fit(np.zeros((0, k)), np.zeros(0, int)).intercept == 0
    assert rule_ensemble.fit(np.zeros((4, k)), np.ones(4, int)).rules == ()


def plain_statistics(text):
    """The thirteen statistics from their descriptions, in plain Python."""
    text = text or ""
    words = re.findall(r"[^ \t\n\x0b\x0c\r]+", text)
    lines = [x for x in text.split("\n") if x]
    solid = sum(len(w) for w in words)
    share = lambda a, b: a / b if b else 0.0
    count = lambda chars: sum(text.count(c) for c in chars)
    return {
        "log_words": math.log1p(len(words)), "word_length": share(solid, len(words)),
        "distinct_words": share(math.log1p(len(set(words))), math.log1p(len(words))),
        "repeated_neighbours": share(sum(a == b for a, b in zip(words, words[1:])), len(words)),
        "distinct_lines": share(len(set(lines)), len(lines)), "words_per_line": share(len(words), len(lines)),
        "symbols": share(count("#*$%&<>"), len(words)), "bars": share(count("|"), len(words)), "exclamations": share(count("!"), len(words)),
        "punctuation": share(count(".,;:?"), len(words)), "digits": share(count("0123456789"), solid),
        "capitals": share(sum(unicodedata.category(c) == "Lu" for c in text), solid), "code_marks": share(count("{}[]()=\"'/\\_@"), len(words)),
    }


def test_statistics_equal_plain_python(spark):
    sample = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(i, t) for i, t, *_ in corpus()] + [tuple(r) for r in sample.collect()]
    rng = np.random.default_rng(4)
    rows += [(1000 + k, "".join(rng.choice(list("aB é\n\t|!#.0{}[]()=\"'/\\_@\x0b"), 60))) for k in range(200)]
    rows += [(2000, "long word " * 300_000), (2001, "A" * 1_000_000), (2002, "\n" * 50_000)]  # very long texts
    texts = {n: t for n, (_, t) in enumerate(rows)}
    df = spark.createDataFrame(list(texts.items()), "n long, text string").repartition(4)
    got = rule_ensemble.statistics(df, keep=["n"]).collect()
    assert len(got) == len(texts)
    for r in got:
        for name, value in plain_statistics(texts[r.n]).items():
            assert math.isclose(r[name], value, rel_tol=1e-9, abs_tol=1e-12), (name, (texts[r.n] or "")[:60])


def test_long_texts_count(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in rng.integers(0, 3000, 60_000)]
    text = " ".join(words[:30_000]) + "\n" + " ".join(words[29_000:])
    row = host_rules.judge(frame(spark, [(1, text, "h", "s")])).first()
    assert (row.n_words, row.n_repeat_words, row.n_dup_lines) == (61_000, repeated(text.split()), 0)


def test_scores_cover_odd_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(24)] + [(None, 1, 0), (3, 0, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, corpus())
    model = rule_ensemble.train(docs, labels)
    got = rule_ensemble.score(docs, model).collect()
    assert len(got) == len(corpus()) and all(0 <= r.score <= 1 for r in got)
    assert rule_ensemble.score(empty(spark), rule_ensemble.train(empty(spark), labels.limit(0))).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = q_rule_ensemble(spark, sf).filter("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    bad = [r for r in rows if r.quality == 0]
    assert right > 0.98 and sum(r.predicted == 0 for r in bad) / len(bad) > 0.97
