"""File selection: G1 select_files, G2 selection_requests, G3 selection_result,
F1 path_prefilter, S4 read_selection, X3 audit_selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.functions import jsonx
from codesift.functions.paths import FLATTEN_EXCLUDE_DIRS, path_parts, path_prefilter_match
from codesift.operators.ordering import head_n, ordinal
from codesift.plans import model
from codesift.plans import prompts as P


def path_prefilter(files: DataFrame) -> DataFrame:
    """drop tests, docs and assets by path pattern."""
    return files.filter(~path_prefilter_match(F.col("path")))


def selection_batches(files: DataFrame, batch_size: int = P.SELECT_BATCH) -> DataFrame:
    """Every path with its request: ``(repo_id, batch, path)``, consecutive paths of a repo in byte order."""
    numbered = ordinal(files.select("repo_id", "path"), ["repo_id"], ["path"], "_n")
    return numbered.select("repo_id", (F.floor((F.col("_n") - 1) / batch_size) + 1).cast("int").alias("batch"), "path")


def selection_requests(files: DataFrame, limit: int | None = None, model_name: str = P.DEFAULT_MODEL,
                       batch_size: int = P.SELECT_BATCH) -> DataFrame:
    """The pre-filtered paths of a repo (byte order), one per line, in requests of ``batch_size`` paths.

    With ``limit`` (the original's way) there is one request with the first ``limit`` paths, plus
    '… and K more files' when some were left out.

    ``files(repo_id, path)`` -> ``(repo_id, batch, n_files, n_offered, file_block, request columns)``.
    """
    prm = model.params(model_name, temperature=P.SELECT_TEMPERATURE)
    if limit is None:
        listed = selection_batches(files, batch_size).groupBy("repo_id", "batch").agg(
            F.expr("listagg(path, '\\n') WITHIN GROUP (ORDER BY path)").alias("file_block"), F.count(F.lit(1)).alias("n_offered"))
        totals = files.groupBy("repo_id").agg(F.count(F.lit(1)).alias("n_files"))
        return model.with_request(listed.join(totals, "repo_id"), P.OP_SELECT, F.lit(P.SELECT_SYSTEM),
                                  F.concat(F.lit(P.SELECT_PROMPT_HEAD), F.col("file_block")), prm)
    offered = head_n(files.select("repo_id", "path"), limit, ["repo_id"], ["path"])
    per_repo = offered.groupBy("repo_id").agg(
        F.expr("listagg(path, '\\n') WITHIN GROUP (ORDER BY path)").alias("head_block"),
        F.count(F.lit(1)).alias("n_offered"),
        F.first("n_total").alias("n_files"),
    )
    rem = F.col("n_files") - F.col("n_offered")
    block = F.concat(F.col("head_block"),
                     F.when(rem > 0, F.format_string(P.SELECT_REMAINDER.replace("{n}", "%d"), rem)).otherwise(F.lit("")))
    per_repo = per_repo.withColumn("file_block", block).withColumn("batch", F.lit(1)).drop("head_block")
    return model.with_request(per_repo, P.OP_SELECT, F.lit(P.SELECT_SYSTEM),
                              F.concat(F.lit(P.SELECT_PROMPT_HEAD), F.col("file_block")), prm)


def parse_selection(answers: DataFrame, content: str = "content") -> DataFrame:
    """T4/T5/F14 on a selection answer: adds ``picked array<string>`` (null = not a list of strings)."""
    v = jsonx.parse_json_strict(jsonx.strip_fence_a(F.col(content)))
    return answers.withColumn(
        "picked", F.when(jsonx.is_string_array(v), jsonx.string_items(v))
    )


def batched_selection_result(files: DataFrame, answers: DataFrame, batch_size: int = P.SELECT_BATCH) -> DataFrame:
    """G3 per request: the picks of every batch that was answered with a list of strings, and all
    paths of the other batches, in (batch, pick) order.

    ``answers(repo_id, batch, content)`` -> ``selection(repo_id, pos, path, origin)``.
    """
    parsed = parse_selection(answers.select("repo_id", F.col("batch").cast("int").alias("batch"), "content")) \
        .filter(F.col("picked").isNotNull())
    picked = parsed.select("repo_id", "batch", F.posexplode("picked").alias("nth", "path")).withColumn("origin", F.lit("model"))
    rest = selection_batches(files, batch_size).join(parsed.select("repo_id", "batch"), ["repo_id", "batch"], "left_anti")
    rest = rest.select("repo_id", "batch", F.lit(0).alias("nth"), "path", F.lit("fallback").alias("origin"))
    return ordinal(picked.unionByName(rest), ["repo_id"], ["batch", "nth", "path"], "pos").select(
        "repo_id", "pos", "path", "origin")


def selection_result(files: DataFrame, answers: DataFrame) -> DataFrame:
    """The model's list when it is a JSON list of strings (``[]`` = none), otherwise
    every pre-filtered file of the repo (not only the offered ones).  No answer = fallback.

    ``files(repo_id, path)`` pre-filtered, ``answers(repo_id, content)`` ->
    ``selection(repo_id, pos, path, origin)``.
    """
    parsed = parse_selection(answers.select("repo_id", "content"))
    picked = (
        parsed.filter(F.col("picked").isNotNull())
        .select("repo_id", F.posexplode_outer("picked").alias("pos0", "path"))
        .filter(F.col("pos0").isNotNull())
        .select("repo_id", (F.col("pos0") + 1).cast("bigint").alias("pos"), "path", F.lit("model").alias("origin"))
    )
    decided = parsed.filter(F.col("picked").isNotNull()).select("repo_id")
    fallback_files = files.select("repo_id", "path").join(decided, "repo_id", "left_anti")
    fallback = ordinal(fallback_files, ["repo_id"], ["path"], "pos").select(
        "repo_id", "pos", "path", F.lit("fallback").alias("origin")
    )
    return picked.unionByName(fallback)


def flattened(files: DataFrame) -> DataFrame:
    """S3's own exclusions on a path table: nothing below a directory that flattening a stored tree skips."""
    dirs = F.slice(path_parts(F.col("path")), 1, F.greatest(F.size(path_parts(F.col("path"))) - 1, F.lit(0)))
    return files.filter(~F.arrays_overlap(dirs, F.array(*[F.lit(x) for x in FLATTEN_EXCLUDE_DIRS])))


def select_files(files: DataFrame, answers: DataFrame) -> DataFrame:
    """G1: exclusions of the flattened tree, pre-filter, then the model's pick."""
    return selection_result(path_prefilter(flattened(files)), answers)


def audit_selection(selection: DataFrame, offered: DataFrame) -> DataFrame:
    """Picked paths that were never offered to the model (exact string match)."""
    return selection.join(offered.select("repo_id", "path"), ["repo_id", "path"], "left_anti")


def read_selection(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """Selection documents ``(repo_id, json)`` -> ``(repo_id, pos, path)``.

    ``files_to_analyze`` wins whenever the key is present (even when empty); otherwise the
    legacy ``folders_to_analyze`` then ``standalone_files``.  A bare list is also accepted.
    """
    v = F.parse_json(F.col(json_col))
    empty = F.array().cast("array<string>")
    current = F.try_variant_get(v, "$.files_to_analyze", "array<string>")
    legacy = F.concat(
        F.coalesce(F.try_variant_get(v, "$.folders_to_analyze", "array<string>"), empty),
        F.coalesce(F.try_variant_get(v, "$.standalone_files", "array<string>"), empty),
    )
    paths = (
        F.when(jsonx.is_array(v), F.try_variant_get(v, "$", "array<string>"))
        .when(jsonx.has_key(v, "files_to_analyze"), F.coalesce(current, empty))
        .otherwise(legacy)
    )
    return docs.select("repo_id", F.posexplode(paths).alias("pos0", "path")).select(
        "repo_id", (F.col("pos0") + 1).cast("bigint").alias("pos"), "path"
    )
