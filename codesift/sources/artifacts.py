"""Artifacts on disk (S6-S10): typed readers, partitioned writers, report export.

Tables are Parquet partitioned by ``repo_id`` (all repos in one job).  The
original tool's JSON documents can be read with the ``*_from_json`` readers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift.functions import jsonx
from codesift.session import materialize

SUBSETS_ENTRY = "array<struct<subset_id string, file_paths array<string>, reason string>>"
SUGGESTIONS_ENTRY = "array<struct<subset_id string, suggested_pipelines array<string>>>"
FINDING_ENTRY = ("struct<file_path string, code_snippet string, description string, vulnerability string, "
                 "severity string, confidence_level string, remediation string, line array<int>>")


def read_json_docs(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON documents as ``(file_name, json)``, one row per file."""
    return spark.read.text(path, wholetext=True).select(
        percent_decode(F.col("_metadata.file_name")).alias("file_name"), F.col("value").alias("json")  # a URI's last part
    )


def percent_decode(name: Column) -> Column:
    """``%xx`` decoded (a plus sign stays); a name that is not encoded stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def subsets_from_json(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """S6 subsets document ``[{subset_id, file_paths, reason}]`` -> rows with ``subset_no``."""
    arr = F.from_json(F.col(json_col), SUBSETS_ENTRY)
    return docs.select("repo_id", F.posexplode(arr).alias("pos0", "s")).select(
        "repo_id", (F.col("pos0") + 1).cast("int").alias("subset_no"), "s.subset_id",
        F.coalesce(F.col("s.file_paths"), F.array().cast("array<string>")).alias("file_paths"), "s.reason",
    )


def suggestions_from_json(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """S6 suggestions document ``[{subset_id, suggested_pipelines}]``."""
    arr = F.from_json(F.col(json_col), SUGGESTIONS_ENTRY)
    return docs.select("repo_id", F.posexplode(arr).alias("pos0", "s")).select(
        "repo_id", (F.col("pos0") + 1).cast("int").alias("subset_no"), "s.subset_id", "s.suggested_pipelines",
    )


def findings_from_json(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """S9 document ``{"vulnerabilities": [finding...]}`` -> rows (``finding_id`` = repo + position)."""
    v = F.parse_json(F.col(json_col))
    arr = F.try_variant_get(v, "$.vulnerabilities", f"array<{FINDING_ENTRY}>")
    rows = docs.select("repo_id", F.posexplode(arr).alias("pos", "f"))
    return rows.select(
        "repo_id", F.concat_ws("#", "repo_id", F.col("pos").cast("string")).alias("finding_id"),
        F.col("pos").cast("bigint").alias("pos"), "f.*",
    )


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by repo; ``overwrite`` replaces only the repos present
    (dynamic partition overwrite), ``append`` adds."""
    df.write.option("partitionOverwriteMode", "dynamic").mode(mode).partitionBy("repo_id").parquet(path)


def write_stage_outputs(stage_outputs: DataFrame, path: str) -> None:
    """One JSON payload per (subset, pipeline, tag) where the stage saves output, partitioned by repo.

    A written payload replaces the earlier one of its (subset, pipeline, tag); others stay.
    """
    spark = stage_outputs.sparkSession
    out = stage_outputs.filter(F.coalesce(F.col("save_output"), F.lit(False)))
    keys = ["repo_id", "subset_id", "pipeline_id", "output_tag"]
    if path_exists(spark, path):
        old = spark.read.parquet(path).select(*[F.col(c).cast(out.schema[c].dataType).alias(c) for c in out.columns])
        touched = out.select("repo_id").distinct()
        kept = old.join(touched, "repo_id", "left_semi").join(out.select(*keys), keys, "left_anti")
        out = materialize(out.unionByName(kept))  # cut off from the files that are about to be replaced
    write_table(out, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on the file system that the path names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def export_reports(docs: DataFrame) -> DataFrame:
    """JSON documents whose ``content`` is a string -> ``(md_name, content)``; lists, bad
    JSON and non-string ``content`` are skipped.  Also returns the count via ``count()``."""
    v = jsonx.parse_json_strict(F.col("json"))
    good = docs.withColumn("_v", v).filter(jsonx.is_object(F.col("_v")) & jsonx.is_string(jsonx.get_field(F.col("_v"), "content")))
    return good.select(
        F.regexp_replace(F.col("file_name"), r"\.json$", ".md").alias("md_name"),
        jsonx.get_string(F.col("_v"), "content").alias("content"),
    )


def write_reports(reports: DataFrame, out_dir: str) -> None:
    """Exported reports as Markdown text, one folder ``md_name=<name>.md`` per report."""
    reports.select("md_name", "content").write.mode("overwrite").partitionBy("md_name").option("lineSep", "\n").text(out_dir)


def findings_documents(findings: DataFrame) -> DataFrame:
    """S9 as the original's document, one row per repo: ``{"vulnerabilities": [...]}`` in suggestion,
    pipeline and model order (W7).  For small results: a document is one value; ``documents.export_findings`` writes any size."""
    fields = ["file_path", "code_snippet", "description", "vulnerability", "severity", "confidence_level", "remediation", "line"]
    entry = F.struct("suggestion_no", "pipeline_pos", "pos", F.struct(*fields).alias("finding"))
    listed = findings.groupBy("repo_id").agg(F.sort_array(F.collect_list(entry)).alias("xs"))
    return listed.select("repo_id", F.to_json(F.struct(F.col("xs.finding").alias("vulnerabilities"))).alias("json"))
