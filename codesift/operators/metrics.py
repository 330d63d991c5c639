"""A4 counters.

The original keeps per-run counters in process memory; here they are rows computed
from the tables themselves (partial counts, one shuffle of tiny rows).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from codesift.session import written


def stage_metrics(stages: dict[str, DataFrame]) -> DataFrame:
    """``(repo_id, stage, n)`` for each named table, e.g. listed / kept / offered / selected /
    metadata files / subsets / findings / removed."""
    parts = [df.groupBy("repo_id").agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit(name))
             for name, df in stages.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).select("repo_id", "stage", "n")


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict]:
    """``df`` written as a table, and aggregates over it (``count``, ``count_if``, ``sum``) collected by the pass that writes it.

    A counter costs no scan of its own; counts per repository read one column of the written table.
    """
    seen = Observation(name)
    out = written(df.observe(seen, *[c.alias(k) for k, c in counts.items()]), f"stage-{name}")
    return out, seen.get
