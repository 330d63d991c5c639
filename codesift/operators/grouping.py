"""Grouping files into subsets: W1 assign_chunks, T8 render_file_line, A1 join_lines,
G6 grouping_requests, G7 parse_grouping (with W2 renumbering), X2 audit_grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesift.functions import jsonx
from codesift.functions.jsonx import strip_fence_b
from codesift.operators.ordering import ordinal
from codesift.plans import model
from codesift.plans import prompts as P
from codesift.session import materialize


def assign_chunks(metadata: DataFrame, size: int = P.FILES_PER_GROUPING_PROMPT) -> DataFrame:
    """Consecutive chunks of ``size`` metadata entries per repo in ``ord`` order;
    adds ``chunk`` (1-based) and ``pos_in_chunk`` (0-based)."""
    numbered = ordinal(metadata, ["repo_id"], ["ord", "path"], "_k")
    return (
        numbered.withColumn("chunk", (F.floor((F.col("_k") - 1) / size) + 1).cast("int"))
        .withColumn("pos_in_chunk", ((F.col("_k") - 1) % size).cast("int"))
        .drop("_k")
    )


def render_file_line(path: Column, side: Column, lang: Column, summary: Column, imports: Column,
                     max_imports: int | None = None) -> Column:
    """T8: '- path [side/lang]: summary | Imports: a, b' (the first ``max_imports`` if given; suffix only when any)."""
    shown = F.coalesce(imports, F.array().cast("array<string>"))
    imp = F.array_join(shown if max_imports is None else F.slice(shown, 1, max_imports), ", ")
    base = F.concat(F.lit("- "), path, F.lit(" ["), F.coalesce(side, F.lit("")), F.lit("/"),
                    F.coalesce(lang, F.lit("")), F.lit("]: "), F.coalesce(summary, F.lit("")))
    return F.when(imp != "", F.concat(base, F.lit(" | Imports: "), imp)).otherwise(base)


def join_lines(df: DataFrame, by: list[str], line: str, order: str, name: str = "text") -> DataFrame:
    """A1: lines of each group joined by '\\n' in ``order``; an empty group gives ''."""
    agg = F.expr(f"listagg({line}, '\\n') WITHIN GROUP (ORDER BY {order})")
    return df.groupBy(*by).agg(F.coalesce(agg, F.lit("")).alias(name))


def grouping_requests(metadata: DataFrame, size: int = P.FILES_PER_GROUPING_PROMPT,
                      model_name: str = P.DEFAULT_MODEL, max_imports: int | None = None) -> DataFrame:
    """One request per (repo, chunk of 60): the fixed instructions, then 'Files:' and one
    rendered line per entry of kind 'file' in ``ord`` order."""
    chunks = assign_chunks(metadata, size)
    lines = chunks.filter(F.col("kind") == "file").withColumn(
        "line", render_file_line(F.col("path"), F.col("side"), F.col("language"), F.col("description"), F.col("imports"),
                                 max_imports)
    )
    per_chunk = join_lines(lines, ["repo_id", "chunk"], "line", "pos_in_chunk", "files_block")
    sizes = chunks.groupBy("repo_id", "chunk").agg(F.count(F.lit(1)).alias("n_entries"))
    per_chunk = sizes.join(per_chunk, ["repo_id", "chunk"], "left").withColumn(
        "files_block", F.coalesce(F.col("files_block"), F.lit(""))
    )
    # A chunk never holds more than ``size`` entries, so the "omitted" line of the original
    # prompt cannot occur and is left out.
    user = F.concat(F.lit(P.GROUP_INSTRUCTIONS + P.GROUP_FILES_HEADER), F.col("files_block"))
    prm = model.params(model_name, temperature=P.GROUP_TEMPERATURE, max_tokens=P.GROUP_MAX_TOKENS)
    return model.with_request(per_chunk, P.OP_GROUP, F.lit(P.GROUP_SYSTEM), user, prm)


def parse_grouping(answered: DataFrame, strict: bool = False, content: str = "content") -> dict[str, DataFrame]:
    """Answers per (repo_id, chunk) -> subsets, renumbered 'subset-001'... per repo.

    An answer is usable when, after fence stripping (F15), it is a non-empty JSON list of
    objects.  Each element keeps ``file_paths`` (string items) and ``reason``; the
    intermediate id '<subset_id>-chunkNN' is kept as ``chunk_subset_id``.  The original
    tool fails the whole step on one bad chunk: ``strict=True`` raises the same way
    (during this call, which parses the answers once and checkpoints them); otherwise ``chunk_status``
    reports the bad chunks and the
    ``ok_repos`` table lists repos whose every chunk parsed.
    """
    arr = F.col("_arr")
    all_objects = F.forall(arr, lambda e: F.coalesce(F.schema_of_variant(e).startswith("OBJECT"), F.lit(False)))
    good = arr.isNotNull() & (F.size(arr) > 0) & F.coalesce(all_objects, F.lit(False))
    status = (
        F.when(F.col(content).isNull(), F.lit("missing"))
        .when(good, F.lit("ok"))
        .otherwise(F.lit("error"))
    )
    told = answered.select("repo_id", "chunk", content)
    told = jsonx.settled(jsonx.with_json(told, strip_fence_b(F.col(content))).withColumn("_arr", jsonx.as_array(F.col("_v"))).drop("_v"), "_arr")
    parsed = jsonx.settled(told.withColumn("chunk_status", status), "chunk_status").drop(content)
    if strict:
        parsed = parsed.withColumn(
            "chunk_status",
            F.when(F.col("chunk_status") == "ok", F.col("chunk_status")).otherwise(
                F.raise_error(F.concat(F.lit("grouping failed for repo "), F.col("repo_id"),
                                       F.lit(" chunk "), F.col("chunk").cast("string")))),
        )
    # subsets, statuses and the range bounds of the numbering all read it
    parsed = materialize(parsed)
    chunk_status = parsed.select("repo_id", "chunk", "chunk_status")
    items = parsed.filter(F.col("chunk_status") == "ok").select(
        "repo_id", "chunk", F.posexplode_outer("_arr").alias("pos", "e")
    ).filter(F.col("pos").isNotNull())
    sid = F.coalesce(jsonx.get_field(F.col("e"), "subset_id"), F.lit(None))
    orig = F.when(sid.isNull(), F.lit(P.GROUP_ID_DEFAULT)).otherwise(jsonx.py_str(sid))
    subsets = items.select(
        "repo_id", "chunk", "pos",
        F.format_string("%s-chunk%02d", orig, F.col("chunk")).alias("chunk_subset_id"),
        F.coalesce(jsonx.string_items(jsonx.get_field(F.col("e"), "file_paths")),
                   F.array().cast("array<string>")).alias("file_paths"),
        jsonx.get_string(F.col("e"), "reason").alias("reason"),
    )
    subsets = ordinal(subsets, ["repo_id"], ["chunk", "pos"], "subset_no")
    subsets = subsets.withColumn("subset_id", F.format_string(P.SUBSET_ID_FORMAT, F.col("subset_no")))
    bad = chunk_status.filter(F.col("chunk_status") != "ok").select("repo_id").distinct()
    ok_repos = chunk_status.select("repo_id").distinct().join(bad, "repo_id", "left_anti")
    return {"subsets": subsets, "chunk_status": chunk_status, "ok_repos": ok_repos}


def audit_grouping(subsets: DataFrame, metadata: DataFrame, min_size: int = 5, max_size: int = 15) -> DataFrame:
    """X2 (rules stated in the grouping prompt): files in no subset, subset paths that are not
    metadata files, subsets outside 5-15 files.  ``(repo_id, issue, subset_id, path, n)``."""
    members = subsets.select("repo_id", "subset_id", F.explode("file_paths").alias("path"))
    files = metadata.filter(F.col("kind") == "file").select("repo_id", "path")
    unassigned = files.join(members.select("repo_id", "path"), ["repo_id", "path"], "left_anti").select(
        "repo_id", F.lit("file_in_no_subset").alias("issue"), F.lit(None).cast("string").alias("subset_id"),
        "path", F.lit(None).cast("bigint").alias("n"),
    )
    unknown = members.join(files, ["repo_id", "path"], "left_anti").select(
        "repo_id", F.lit("unknown_path").alias("issue"), "subset_id", "path", F.lit(None).cast("bigint").alias("n"),
    )
    size = F.size("file_paths").cast("bigint")
    odd = subsets.filter((size < min_size) | (size > max_size)).select(
        "repo_id", F.lit("subset_size").alias("issue"), "subset_id", F.lit(None).cast("string").alias("path"),
        size.alias("n"),
    )
    return unassigned.unionByName(unknown).unionByName(odd)
