"""Files tables.

The engine works on ``files(repo_id, path, content)``.  Two ways in:

* ``documents_as_files``: a document table with text becomes a file table by a
  deterministic path rule (used for the test tables: ``source`` is the repo).
* ``listing.list_files`` and ``listing.read_contents`` (S1): a real directory walk, see ``listing.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Path rule for document tables: src/<DIR[(doc_id div 20) % 7]>/doc<doc_id>.<EXT[(doc_id div 3) % 8]>
# (the test tables give doc_id % 20 as the source, so the divisions vary paths inside a repo)
DIR_STEP = 20
EXT_STEP = 3
CORPUS_DIRS = ["controllers", "tests", "models", "node_modules", "__tests__", "coverage", "Archive"]
CORPUS_EXTS = ["js", "jsx", "ts", "py", "md", "css", "test.js", "JSON"]

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus_path(doc_id: F.Column) -> F.Column:
    d_ix = (F.floor(doc_id / DIR_STEP) % len(CORPUS_DIRS)).cast("int") + 1
    e_ix = (F.floor(doc_id / EXT_STEP) % len(CORPUS_EXTS)).cast("int") + 1
    d = F.element_at(F.array(*[F.lit(x) for x in CORPUS_DIRS]), d_ix)
    e = F.element_at(F.array(*[F.lit(x) for x in CORPUS_EXTS]), e_ix)
    return F.concat(F.lit("src/"), d, F.lit("/doc"), doc_id.cast("string"), F.lit("."), e)


def documents_as_files(documents: DataFrame) -> DataFrame:
    """files(repo_id, path, content, doc_id) from documents(doc_id, text, source, ...)."""
    return documents.select(
        F.col("source").alias("repo_id"),
        corpus_path(F.col("doc_id")).alias("path"),
        F.col("text").alias("content"),
        F.col("doc_id"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document table as files; the reader's split size decides the partitions."""
    return documents_as_files(read_table(spark, sf_dir, "documents"))
