"""The corpus pipeline: quality rules, line deduplication, n-gram join, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of
``documents``.  ``run`` writes each stage's result under the shared checkpoint folder and hands the
written table to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift.llm import decontaminate, host_rules, line_dedup, ngram_join, packing
from codesift.llm.queries import tokenizer_path
from codesift.llm.staging import staged
from codesift.sources.corpus import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule on hosts that are not rejected."""
    return host_rules.keep_documents(docs)


def line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; ``n_chars`` follows the text."""
    kept = line_dedup.keep_first_copies(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 on five-word shingles."""
    return ngram_join.keep_one_per_group(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_runs),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]

#: No SQL: the join, the edit matching and the tokenizer cannot be stated in it; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
