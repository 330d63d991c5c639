"""Directories as ranges over the byte order of paths.

The files below directory ``d`` are exactly the paths from ``d/`` (included) to ``d0`` (excluded: ``0`` follows ``/``), and two
such ranges are nested or apart.  So "the first of the selected directories above each file" needs no row per (file, ancestor):
files and range ends are sorted together once, and the label in force at a file is the one that the last range end before it
set.  What travels is one row per file and two per directory, whatever the depth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codesift.functions.paths import ancestor_dirs
from codesift.session import written


def _labels(dirs: DataFrame) -> DataFrame:
    """``(repo_id, dir, pos)`` -> also ``inside`` (the least ``pos`` in force from its start on) and ``outside`` (after its end;
    null ``sel``: none), from the selected directories above it.  Only directories are expanded here, not files."""
    above = dirs.filter(F.col("dir") != "").select("repo_id", "dir", F.explode(ancestor_dirs("dir")).alias("up"))
    above = above.join(dirs.select("repo_id", F.col("dir").alias("up"), F.col("pos").alias("up_pos")), ["repo_id", "up"])
    above = above.groupBy("repo_id", "dir").agg(F.min("up_pos").alias("up_pos"), F.lit(True).alias("_up"))
    d = dirs.join(above, ["repo_id", "dir"], "left")
    return d.select(
        "repo_id", "dir",
        F.struct(F.lit(True).alias("sel"), F.least("pos", "up_pos").alias("pos")).alias("inside"),
        F.struct(F.coalesce("_up", F.lit(False)).alias("sel"), F.col("up_pos").alias("pos")).alias("outside"),
    )


def sweep_rows(files: DataFrame, dirs: DataFrame) -> DataFrame:
    """The rows that are sorted: every file, and a start and an end for every directory."""
    d = _labels(dirs)
    root = F.col("dir") == ""
    label = d.schema["inside"].dataType
    point = files.select("repo_id", F.lit(False).alias("_after"), F.col("path").alias("_key"), F.lit(2).alias("_kind"),
                         F.lit(None).cast(label).alias("_mark"), F.lit(None).cast("string").alias("dir"))
    start = d.select("repo_id", F.lit(False).alias("_after"), F.when(root, F.lit("")).otherwise(F.concat("dir", F.lit("/"))).alias("_key"),
                     F.lit(0).alias("_kind"), F.col("inside").alias("_mark"), "dir")
    # the root's range ends behind the repository's last path
    end = d.select("repo_id", root.alias("_after"), F.concat("dir", F.lit("0")).alias("_key"), F.lit(1).alias("_kind"),
                   F.col("outside").alias("_mark"), "dir")
    return point.unionByName(start).unionByName(end)


def files_below(files: DataFrame, dirs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ``files(repo_id, path)`` and distinct ``dirs(repo_id, dir, pos)``: the files below a directory with the least ``pos``
    of the directories above them, ``(repo_id, path, pos)``, and the directories that have files, ``(repo_id, dir)``.

    One range sort; each partition is swept alone (a hot repository spans many), then shifted by what the partitions
    before it leave open, a table of one row per partition.
    """
    files = files.filter(F.col("repo_id").isNotNull() & F.col("path").isNotNull())
    dirs = dirs.filter(F.col("repo_id").isNotNull() & F.col("dir").isNotNull())
    order = ["repo_id", "_after", "_key", "_kind"]
    # written once: range bounds come from sampling, and a second evaluation could place rows differently
    rows = written(
        sweep_rows(files, dirs).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()),
        "range-sweep")
    is_file = (F.col("_kind") == 2).cast("bigint")
    before = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_own", F.last("_mark", ignorenulls=True).over(before)).withColumn("_files", F.sum(is_file).over(before))
    mark = F.struct("_mid", "_mark")
    parts = rows.groupBy("_pid").agg(F.max(F.when(F.col("_mark").isNotNull(), mark))["_mark"].alias("_last"), F.sum(is_file).alias("_n"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = parts.select("_pid", F.last("_last", ignorenulls=True).over(earlier).alias("_open"),
                         F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    swept = local.join(parts, "_pid").withColumn("_label", F.coalesce("_own", "_open"))
    below = swept.filter((F.col("_kind") == 2) & F.col("_label.sel")).select("repo_id", F.col("_key").alias("path"), F.col("_label.pos").alias("pos"))
    seen = F.col("_files") + F.col("_shift")
    full = swept.filter(F.col("_kind") < 2).groupBy("repo_id", "dir").agg((F.max(seen) > F.min(seen)).alias("_any"))
    return below, full.filter("_any").select("repo_id", "dir")
