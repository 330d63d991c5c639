"""Quality classifier: a sparse rule ensemble over text statistics.

1. Statistics of each whole text are native column expressions (word, line and character shares).
2. Shallow boosted trees are grown on a bounded sample of labelled rows; every path from a root to
   a node is a rule, a conjunction of ``statistic <= or > threshold`` tests.
3. A lasso logistic regression over the rules keeps few of them.
4. The kept rules compile into one Spark column expression, so scoring is a single pass over the
   documents without a shuffle and without Python.

Only the fit sees labels.  Its sample is the ``SAMPLE_ROWS`` labelled rows whose id hashes are smallest, a
documented bound; everything else covers all rows.

Defined cases: a null text counts as empty; an empty text has statistics 0 and gets a score like any
other; ids labelled twice with different labels are left out of the fit; with no usable labels, or one class
only, the score is the share of label 1 (0.5 without labels) for every row; repeated rows
score alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
N_TREES = 24
DEPTH = 3
LEARNING_RATE = 0.3
N_THRESHOLDS = 24
LASSO = 1e-3
MIN_SUPPORT = 0.005
CUTOFF = 0.7

_BLANKS = " \t\n\x0b\x0c\r"


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and one double column per statistic (see ``STATISTICS``)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = docs.select(*(keep or []), text.alias("_text"))
    row = row.withColumn("_words", F.array_remove(F.split("_text", "[ \\x09-\\x0D]+"), "")) \
        .withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: F.length(x) > 0))
    t, words, lines = F.col("_text"), F.size("_words"), F.size("_lines")
    solid = F.length(F.translate(t, _BLANKS, ""))
    repeats = F.size(F.filter("_words", lambda w, i: w == F.get("_words", i - 1)))
    return row.select(
        *(keep or []),
        F.log1p(words).alias("log_words"),
        _share(solid, words).alias("word_length"),
        # the share of logarithms, which for ordinary prose hardly depends on the length
        _share(F.log1p(F.size(F.array_distinct("_words"))), F.log1p(words)).alias("distinct_words"),
        _share(repeats, words).alias("repeated_neighbours"),
        _share(F.size(F.array_distinct("_lines")), lines).alias("distinct_lines"),
        _share(words, lines).alias("words_per_line"),
        _share(_count(t, "#*$%&<>"), words).alias("symbols"),
        _share(_count(t, "|"), words).alias("bars"),
        _share(_count(t, "!"), words).alias("exclamations"),
        _share(_count(t, ".,;:?"), words).alias("punctuation"),
        _share(_count(t, "0123456789"), solid).alias("digits"),
        _share(F.length(F.regexp_replace(t, "[^\\p{Lu}]+", "")), solid).alias("capitals"),
        _share(_count(t, "{}[]()=\"'/\\_@"), words).alias("code_marks"),
    )


STATISTICS = ["log_words", "word_length", "distinct_words", "repeated_neighbours", "distinct_lines", "words_per_line",
              "symbols", "bars", "exclamations", "punctuation", "digits", "capitals", "code_marks"]

#: A test is (statistic, is_greater, threshold); a rule is a tuple of tests.
Test = tuple[str, bool, float]
Rule = tuple[Test, ...]


@dataclass(frozen=True)
class RuleModel:
    """An intercept and the weighted rules that the lasso kept."""

    intercept: float
    rules: tuple[tuple[float, Rule], ...]

    def score(self) -> Column:
        """The probability of label 1 as one column expression over the statistics."""
        total = F.lit(self.intercept)
        for weight, rule in self.rules:
            holds = F.lit(True)
            for name, greater, threshold in rule:
                holds = holds & (F.col(name) > threshold if greater else F.col(name) <= threshold)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def _grow(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, rows: np.ndarray, cuts: list[np.ndarray],
          depth: int, path: Rule, rules: set[Rule], step: np.ndarray) -> None:
    """One boosted tree: adds its paths to ``rules`` and its leaf values to ``step``."""
    if path:
        rules.add(path)
    best = (1e-6, None)
    g, h = gradient[rows], hessian[rows]
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    if depth:
        for f, thresholds in enumerate(cuts):
            values = x[rows, f]
            for cut in thresholds:
                right = values > cut
                n = int(right.sum())
                if n < 5 or len(rows) - n < 5:
                    continue
                gr, hr = g[right].sum(), h[right].sum()
                gl, hl = g.sum() - gr, h.sum() - hr
                gain = gr * gr / (hr + 1.0) + gl * gl / (hl + 1.0) - whole
                if gain > best[0]:
                    best = (gain, (f, float(cut), right))
    if best[1] is None:
        step[rows] = -g.sum() / (h.sum() + 1.0)
        return
    f, cut, right = best[1]
    name = STATISTICS[f]
    _grow(x, gradient, hessian, rows[~right], cuts, depth - 1, (*path, (name, False, cut)), rules, step)
    _grow(x, gradient, hessian, rows[right], cuts, depth - 1, (*path, (name, True, cut)), rules, step)


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, greater, threshold in rule:
        values = x[:, STATISTICS.index(name)]
        out &= values > threshold if greater else values <= threshold
    return out


def _lasso(a: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on the weights, not on the intercept (accelerated proximal gradient)."""
    n, m = a.shape
    full = np.hstack([np.ones((n, 1)), a])
    rate = 4.0 * n / max(np.linalg.norm(full, 2) ** 2, 1e-9)
    w = np.zeros(m + 1)
    v, momentum = w.copy(), 1.0
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(full @ v, -40, 40)))
        new = v - rate * (full.T @ (p - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0.0)
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        v = new + (momentum - 1) / following * (new - w)
        w, momentum = new, following
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray) -> RuleModel:
    """Trees, rules and lasso over a sample: ``x`` has one column per statistic, ``y`` is 0 or 1."""
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return RuleModel(float(np.log(share / (1 - share))), ())
    quantiles = np.linspace(0, 1, N_THRESHOLDS + 2)[1:-1]
    # thresholds at quantiles of all rows and of the rarer label's rows
    rare = y == (1 if y.mean() < 0.5 else 0)
    cuts = [np.unique(np.concatenate([np.quantile(x[:, f], quantiles), np.quantile(x[rare, f], quantiles)]))
            for f in range(x.shape[1])]
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    rules: set[Rule] = set()
    for _ in range(N_TREES):
        p = 1.0 / (1.0 + np.exp(-margin))
        step = np.zeros(len(y))
        _grow(x, p - y, p * (1 - p), np.arange(len(y)), cuts, DEPTH, (), rules, step)
        margin += LEARNING_RATE * step
    by_rows: dict[bytes, Rule] = {}
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        held = _holds(rule, x)
        if MIN_SUPPORT <= held.mean() <= 1 - MIN_SUPPORT:
            by_rows.setdefault(np.packbits(held).tobytes(), rule)
    kept = list(by_rows.values())
    if not kept:
        return RuleModel(float(np.log(y.mean() / (1 - y.mean()))), ())
    a = np.column_stack([_holds(r, x) for r in kept]).astype(float)
    intercept, weights = _lasso(a, y.astype(float), LASSO)
    return RuleModel(intercept, tuple((float(w), r) for w, r in zip(weights, kept) if abs(w) > 1e-6))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit on a bounded sample of labelled documents.

    At most ``sample_rows`` (id, label) rows are broadcast to meet the documents where they lie, and
    as many rows of statistics come back.
    """
    one = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_y"), F.max(label_col).alias("_most")) \
        .filter(F.col("_y") == F.col("_most")).select("_id", "_y")
    sample = F.broadcast(one.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(sample, "_id")
    rows = statistics(texts, "_t", ["_id", "_y"]).orderBy(F.xxhash64("_id"), "_id", *STATISTICS).limit(sample_rows) \
        .toPandas()
    return fit(rows[STATISTICS].to_numpy(float), rows["_y"].to_numpy(int))


def score(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text",
          cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, score, predicted) per document."""
    rows = statistics(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t")), "_t", ["doc_id"])
    return rows.select("doc_id", model.score().alias("score")) \
        .withColumn("predicted", F.when(F.col("score") >= cutoff, 1).otherwise(0))
