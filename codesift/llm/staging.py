"""Written tables that cut lineage between the steps of an operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.session import scratch_path


#: Spark's own switch for removing the shuffle files of a finished execution.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Unlike a checkpoint the table is columnar and compressed, so later steps read only the
    columns they use; a lost executor re-reads files instead of recomputing the step.  The
    shuffle files behind the table are of no more use once it is written and are removed at once.
    The folder belongs to the cluster's checkpoint folder and is cleared with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the named columns computed once per row, where they stand.

    The optimizer moves a filter below the projections whose columns it tests and then evaluates their
    expressions inside it, nested array expressions over and over.  A filter on the output of a
    generator stays above it.
    """
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.inline_outer(F.array(F.struct(*names))))
