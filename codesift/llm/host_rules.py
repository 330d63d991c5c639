"""Quality rules with host-level verdicts.

Each document is tested against word and line rules; failures are summed by host (``source``), the
hosts' failure rates are shrunk towards the corpus rate with a beta prior whose strength is fitted to
all hosts (method of moments), and a host whose shrunk rate of some rule exceeds that rule's limit is
rejected.  A document is kept if it passes the base rule and its host is not rejected.

Only DataFrame functions are used.  Everything about one document is computed inside its own row,
without a shuffle; only (host, counts) are shuffled, after partial aggregation, so a host with a third
of all rows costs one partial row per task.  Rejected hosts are joined back on the host with an ordinary
join: adaptive execution broadcasts the table when it is small and splits the hot host when it is not.

Defined cases: a null text has no words and fails the base rule; null hosts together are one host;
repeated rows are judged alike; an empty table gives an empty result (no host is rejected); extra
columns are ignored by ``judge`` and passed through by ``keep_documents``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesift.llm.staging import settled, staged

#: Fixed values of the rules: separators are space and \\x09-\\x0D, symbols are [#*$%&|<>].
SPACES = " \t\n\x0b\x0c\r"
SPLIT = "[ \\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
#: A document fails the symbol rule above this many symbols per 100 words, the line rule above this share of repeated lines.
MAX_SYMBOL_PCT = 50
MAX_DUP_LINE_PCT = 30
#: Rules whose failures are pooled by host; a host is rejected when its shrunk failure rate exceeds the limit.
HOST_LIMITS = {"fail_base": 0.5, "fail_symbols": 0.5, "fail_lines": 0.5}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeat_words(row: DataFrame) -> DataFrame:
    """Replaces ``words`` by ``n_repeat_words``: how many words lie in an eight-word window that the
    document contains at least twice.

    Window hashes are compared by a distinct count; only where that shows a repeat are they sorted
    with their positions.  Equal neighbours give the repeated positions, and each position covers
    ``min(8, gap to the next)`` words.
    """
    n_windows = F.size("words") - F.lit(WINDOW - 1)
    row = row.withColumn("hashes", F.when(n_windows > 0, F.transform(
        F.sequence(F.lit(1), n_windows), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))))
    row = row.withColumn("sorted", F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, i: x["h"] == F.get("sorted", i)["h"]
    row = row.withColumn("at", F.array_sort(F.transform(
        F.filter("sorted", lambda x, i: F.coalesce(same(x, i - 1), F.lit(False)) | F.coalesce(same(x, i + 1), F.lit(False))),
        lambda x: x["i"])))
    steps = F.transform("at", lambda p, i: F.least(F.coalesce(F.get("at", i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0), lambda total, x: total + x)
    return row.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")) \
        .drop("words", "hashes", "sorted", "at")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(doc_id, host, the five counts, base_failed, fail_*) per document, in the document's own row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: _without(x, SPACES) != "")
    row = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
        F.array_remove(F.split(text, SPLIT), "").alias("words"),
        F.length(_without(text, SPACES)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("lines"))
    row = row.withColumn("n_words", F.size("words").cast("long")) \
        .withColumn("n_lines", F.size("lines").cast("long")) \
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    row = _repeat_words(row)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return row.withColumn("base_failed", failed).select(
        "doc_id", "host", *COUNTS, "base_failed",
        F.col("base_failed").alias("fail_base"),
        (100 * F.col("n_symbols") > MAX_SYMBOL_PCT * F.col("n_words")).alias("fail_symbols"),
        (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PCT * F.col("n_lines")).alias("fail_lines"))


def host_verdicts(measured: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """(host, n_docs, rate_<rule>..., rejected): one row per host, rates shrunk by the fitted prior."""
    limits = HOST_LIMITS if limits is None else limits
    hosts = staged(measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(F.col(r).cast("long")).alias(r) for r in limits]), "host-counts")
    prior = hosts.agg(
        F.sum("n_docs").alias("n"), F.avg(1 / F.col("n_docs")).alias("inv"),
        *[F.sum(r).alias(f"sum_{r}") for r in limits],
        *[F.var_pop(F.col(r) / F.col("n_docs")).alias(f"var_{r}") for r in limits]).first()  # one row
    rejected, out = F.lit(False), hosts
    for rule, limit in limits.items():
        mean = (prior[f"sum_{rule}"] or 0) / prior["n"] if prior["n"] else 0.0
        spread = mean * (1 - mean)
        between = max((prior[f"var_{rule}"] or 0.0) - spread * (prior["inv"] or 0.0), 1e-6)
        strength = min(max(spread / between - 1, 1.0), 1e4)
        rate = (F.col(rule) + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
        out = out.withColumn(f"rate_{rule}", rate)
        rejected = rejected | (F.col(f"rate_{rule}") > limit)
    return out.withColumn("rejected", rejected).drop(*limits)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          limits: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, the five counts, base_failed, kept) per document."""
    measured = staged(measure(docs, id_col, text_col, host_col), "quality-counts")
    bad = host_verdicts(measured, limits).filter("rejected").select(F.col("host").alias("bad_host"), "rejected")
    joined = measured.join(bad, F.col("host").eqNullSafe(F.col("bad_host")), "left")
    kept = ~F.col("base_failed") & F.col("rejected").isNull()
    return joined.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"))


def keep_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                   limits: dict[str, float] | None = None) -> DataFrame:
    """The kept rows of ``docs`` with all their columns.

    The text is read twice (host counts, then the filter) and never shuffled.
    """
    # the whole row travels as one struct, so that no column name of ``docs`` can clash
    slim = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"), F.col(host_col).alias("source"))
    bad = host_verdicts(measure(slim, "source"), limits).filter("rejected").select("host")
    tested = _with_base(slim).select("doc", "source", "base_failed")
    passed = settled(tested, "base_failed").filter(~F.col("base_failed"))
    return passed.join(bad, F.col("source").eqNullSafe(F.col("host")), "left_anti").select("doc.*")


def _with_base(slim: DataFrame) -> DataFrame:
    row = slim.withColumn("words", F.array_remove(F.split(F.coalesce("text", F.lit("")), SPLIT), "")).drop("text") \
        .withColumn("n_words", F.size("words").cast("long"))
    row = _repeat_words(row)
    return row.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))
