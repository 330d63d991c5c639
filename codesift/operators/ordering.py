"""Ordering operators: skew-safe numbering (W1/W2 basis), head-N (W3), stable distinct.

Every cap in the original tool depends on list order; here order is explicit
(``ord`` = rank of ``path`` in byte order unless a caller gives another order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesift.session import materialize


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def ordinal(df: DataFrame, by: list[str], order: list[str | Column], name: str = "ord") -> DataFrame:
    """1-based consecutive number of each row within its ``by`` group in ``order``.

    A plain ``row_number() over (partition by repo_id ...)`` sends a whole repository
    to one task.  Here rows are range-partitioned on ``by + order`` (a hot group
    spans many partitions), numbered locally with ``monotonically_increasing_id``
    after a local sort, and shifted by the sizes of the preceding partitions of the
    same group.  The offsets table has one row per (group, partition) it touches;
    AQE broadcasts it when small.  ``order`` must be unique within a group for a
    deterministic result.  The tagged rows (keys and payload, normally path-level
    columns, not file text) are checkpointed.
    """
    keys = _cols(by) + _cols(order)
    # Range bounds come from sampling, which depends on the arrival order of rows; the
    # tagged rows are therefore checkpointed once so the offsets and the numbering read the
    # very same partition assignment.
    tagged = materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    stats = tagged.groupBy(*by, "_pid").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    return (
        tagged.join(offsets, [*by, "_pid"], "inner")
        .withColumn(name, (F.col("_offset") + F.col("_mid") - F.col("_first") + 1).cast("bigint"))
        .drop("_pid", "_mid", "_first", "_offset")
    )


def head_n(df: DataFrame, n: int, by: list[str], order: list[str | Column], remainder: bool = True) -> DataFrame:
    """First ``n`` rows per group in ``order`` plus, optionally, ``n_total`` of the group.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before the shuffle,
    so each map task forwards at most ``n`` rows per group; totals are a partial count.
    """
    w = Window.partitionBy(*by).orderBy(*_cols(order))
    top = df.withColumn("rank_in_group", F.row_number().over(w)).filter(F.col("rank_in_group") <= n)
    if not remainder:
        return top
    totals = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_total"))
    return top.join(totals, by, "inner")


def distinct_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the one earliest in ``order`` (``dropDuplicates`` keeps any row).

    ``min(struct(order..., rest...))`` is a partial aggregate, so hot keys are combined map-side.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_first")
    return df.groupBy(*key).agg(packed).select(*key, *[F.col("_first")[c].alias(c) for c in order + rest])
