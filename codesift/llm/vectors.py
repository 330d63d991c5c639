"""Which rows of a vector table take part in vector operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _finite(x: Column) -> Column:
    x = x.cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): rows whose vector is not null, is not empty, has finite entries only and the usual width.

    Vectors of different widths cannot be compared; the width that most rows have (of equally frequent ones the larger)
    counts, rows of another width take no part.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("v")) \
        .filter((F.size("v") > 0) & F.forall("v", _finite))
    widths = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    return rows.filter(F.size("v") == (widths[0].width if widths else 0))
