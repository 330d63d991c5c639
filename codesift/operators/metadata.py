"""Per-file metadata: J1/J2 expand_selection, F5-F8 profile, J3 detect_changes,
G5 summary_requests / parse_summary, J4 upsert_metadata, G4 build_metadata, S5 read_metadata.

Unchanged files (same SHA-1, description present) are never sent to the model:
hash first, call later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codesift.functions import jsonx
from codesift.functions.paths import detect_language, path_parts
from codesift.functions.text import decode_ignore, head_chars, loc, py_strip, sha1_hex, token_estimate
from codesift.operators.ordering import distinct_first, head_n, ordinal
from codesift.operators.ranges import files_below
from codesift.plans import model
from codesift.plans import prompts as P
from codesift.session import materialize, written

METADATA_SCHEMA = T.StructType([
    T.StructField("repo_id", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("side", T.StringType()),
    T.StructField("loc", T.LongType()),
    T.StructField("imports", T.ArrayType(T.StringType())),
    T.StructField("description", T.StringType()),
    T.StructField("sha1", T.StringType()),
    T.StructField("token_estimate", T.LongType()),
    T.StructField("ord", T.LongType()),
])
METADATA_COLUMNS = [f.name for f in METADATA_SCHEMA.fields]


def text_of(content_col: str, dtype: T.DataType) -> F.Column:
    """Decoded text of a content column (binary: UTF-8 with bad bytes dropped)."""
    return decode_ignore(F.col(content_col)) if isinstance(dtype, T.BinaryType) else F.col(content_col)


def expand_selection(selection: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J1 + J2 + U2: selected paths -> distinct files in first-seen order.

    A selected directory expands to every file below it in the **unfiltered** listing
    (exclusions and depth do not apply); a selected file stays.  Returns
    ``(expanded(repo_id, path, pos, sub_path), missing(repo_id, pos, path))``.  Directories
    are ranges over the sorted paths (``ranges.files_below``): no row per (file, ancestor).
    """
    # as path joining does, empty and "." parts drop: "src/" and "./src/a.js" mean src and src/a.js
    sel = selection.select("repo_id", "pos", F.array_join(path_parts(F.col("path")), "/").alias("sel_path"))
    listing = files.select("repo_id", "path")
    # joins by column name: selection and listing often share lineage (self-join)
    exact = sel.withColumnRenamed("sel_path", "path").join(listing, ["repo_id", "path"], "inner").select(
        "repo_id", "path", "pos", F.lit("").alias("sub_path")
    )
    dirs = sel.groupBy("repo_id", F.col("sel_path").alias("dir")).agg(F.min("pos").alias("pos"))
    below, full = files_below(listing, dirs)
    under = below.select("repo_id", "path", "pos", F.col("path").alias("sub_path"))
    expanded = distinct_first(exact.unionByName(under), ["repo_id", "path"], ["pos", "sub_path"])
    hits = exact.select("repo_id", F.col("path").alias("sel_path")).unionByName(full.withColumnRenamed("dir", "sel_path")).distinct()
    missing = sel.join(hits, ["repo_id", "sel_path"], "left_anti")
    return expanded, missing.select("repo_id", "pos", F.col("sel_path").alias("path"))


def profile(files: DataFrame, content: str = "content") -> DataFrame:
    """Language, loc, token estimate and SHA-1 of each file; keeps ``text``."""
    dtype = files.schema[content].dataType
    return (
        files.withColumn("text", text_of(content, dtype))
        .withColumn("sha1", sha1_hex(F.col(content)))
        .withColumn("language", detect_language(F.col("path")))
        .withColumn("loc", loc(F.col("text")))
        .withColumn("token_estimate", token_estimate(F.col("text")))
    )


def detect_changes(cur: DataFrame, prev: DataFrame) -> DataFrame:
    """Status per current file: 'new' (no previous row), 'changed' (hash differs or no
    description), 'unchanged'.  Adds ``prev_description``, ``prev_imports``."""
    p = prev.select(
        "repo_id", "path",
        F.col("sha1").alias("prev_sha1"),
        F.col("description").alias("prev_description"),
        F.col("imports").alias("prev_imports"),
        F.lit(True).alias("_had_prev"),
    )
    joined = cur.join(p, ["repo_id", "path"], "left")
    status = (
        F.when(F.col("_had_prev").isNull(), F.lit("new"))
        .when(~F.col("prev_sha1").eqNullSafe(F.col("sha1")) | F.col("prev_description").isNull(), F.lit("changed"))
        .otherwise(F.lit("unchanged"))
    )
    return joined.withColumn("change", status).drop("_had_prev")


def summary_requests(changed: DataFrame, model_name: str = P.SUMMARY_MODEL, max_chars: int | None = None) -> DataFrame:
    """G5 request: the file's text (its first ``max_chars`` characters if given) inside the fixed instructions."""
    user = F.concat(F.lit(P.SUMMARY_PROMPT_HEAD), head_chars(F.col("text"), max_chars), F.lit(P.SUMMARY_PROMPT_TAIL))
    prm = model.params(model_name, temperature=P.SUMMARY_TEMPERATURE, max_tokens=P.SUMMARY_MAX_TOKENS)
    return model.with_request(changed, P.OP_SUMMARY, F.lit(P.SUMMARY_SYSTEM), user, prm)


def parse_summary(answered: DataFrame, content: str = "content") -> DataFrame:
    """G5 answer: ``{"summary": str, "imports": list}``; missing keys give '' and [].

    Adds ``description``, ``imports`` and ``summary_status`` ('ok', 'error' for a bad answer,
    'missing' for no answer).  Where the original tool aborts the step, this keeps a row.
    """
    v = F.col("_v")
    summ = jsonx.get_field(v, "summary")
    imps = jsonx.get_field(v, "imports")
    summary_ok = summ.isNull() | (F.schema_of_variant(summ) == "STRING")
    imports_ok = imps.isNull() | F.schema_of_variant(imps).startswith("ARRAY")
    ok = jsonx.is_object(v) & summary_ok & imports_ok
    status = (
        F.when(F.col(content).isNull(), F.lit("missing"))
        .when(ok, F.lit("ok"))
        .otherwise(F.lit("error"))
    )
    empty = F.array().cast("array<string>")
    return (
        jsonx.settled(jsonx.with_json(answered, py_strip(F.col(content))).withColumn("summary_status", status), "summary_status")
        .withColumn("description", F.when(F.col("summary_status") == "ok", F.coalesce(jsonx.get_string(F.col("_v"), "summary"), F.lit(""))))
        .withColumn("imports", F.when(F.col("summary_status") == "ok", F.coalesce(jsonx.as_strings(jsonx.get_field(F.col("_v"), "imports")), empty))
                    .otherwise(empty))
        .drop("_v")
    )


def upsert_metadata(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Rebuilt rows replace old ones in place (keep their ``ord``); untouched old rows stay;
    new keys are appended after the repo's last ``ord`` in ``cur.ord`` order."""
    keep_old = prev.join(cur.select("repo_id", "path"), ["repo_id", "path"], "left_anti")
    old_ord = prev.select("repo_id", "path", F.col("ord").alias("_old_ord"))
    max_ord = prev.groupBy("repo_id").agg(F.max("ord").alias("_max_ord"))
    c = cur.join(old_ord, ["repo_id", "path"], "left")
    replaced = c.filter(F.col("_old_ord").isNotNull()).withColumn("ord", F.col("_old_ord"))
    fresh = c.filter(F.col("_old_ord").isNull()).drop("ord")
    fresh = ordinal(fresh, ["repo_id"], ["_order_pos", "path"], "_n").join(max_ord, "repo_id", "left")
    fresh = fresh.withColumn("ord", F.coalesce(F.col("_max_ord"), F.lit(0)) + F.col("_n"))
    cols = METADATA_COLUMNS
    return keep_old.select(*cols).unionByName(replaced.select(*cols)).unionByName(fresh.select(*cols))


def empty_metadata(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], METADATA_SCHEMA)


def read_metadata(spark: SparkSession, path: str | None) -> DataFrame:
    """Previous metadata table, or an empty one when there is none yet."""
    if path is None:
        return empty_metadata(spark)
    try:
        return spark.read.schema(METADATA_SCHEMA).parquet(path)
    except Exception as exc:  # missing path -> first run
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return empty_metadata(spark)
        raise


def metadata_from_json(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """S5 for the original tool's document: ``{path: {kind, language, loc, ...}}`` per repo;
    ``ord`` is the key's position in the document."""
    entry = ("struct<kind string, language string, side string, loc bigint, imports array<string>, "
             "description string, sha1 string, token_estimate bigint>")
    m = F.from_json(F.col(json_col), f"map<string, {entry}>")
    rows = docs.select("repo_id", F.posexplode(m).alias("pos0", "path", "e"))
    return rows.select(
        "repo_id", "path", "e.kind", "e.language", F.coalesce(F.col("e.side"), F.lit("")).alias("side"),
        "e.loc", "e.imports", "e.description", "e.sha1", "e.token_estimate",
        (F.col("pos0") + 1).cast("bigint").alias("ord"),
    )


def build_metadata(selection: DataFrame, files: DataFrame, prev: DataFrame | None = None,
                   responses: DataFrame | None = None, provider=None, max_files: int | None = None,
                   model_name: str = P.SUMMARY_MODEL, content: str = "content",
                   max_chars: int | None = None) -> dict[str, DataFrame]:
    """Expand, deduplicate, cap if ``max_files`` is given, profile, reuse or re-summarise, upsert.

    Returns ``metadata`` (the new full table), ``processed`` (this run's rows with
    ``change`` and ``summary_status``), ``requests`` (only for changed files) and
    ``missing`` (selected paths that do not exist).
    """
    spark = files.sparkSession
    prev = prev if prev is not None else empty_metadata(spark)
    expanded, missing = expand_selection(selection, files)
    if max_files is not None:
        expanded = head_n(expanded, max_files, ["repo_id"], ["pos", "sub_path"], remainder=False).drop("rank_in_group")
    cur = profile(expanded.join(files.select("repo_id", "path", content), ["repo_id", "path"], "inner"), content)
    # the files' text is read and hashed once: requests, reuse and output read this table, which has the text of changed files only
    cur = detect_changes(cur, prev).drop(content)
    cur = written(cur.withColumn("text", F.when(F.col("change") != "unchanged", F.col("text"))), "current-files")
    need = cur.filter(F.col("change") != "unchanged")
    reqs = summary_requests(need, model_name, max_chars)
    answered = model.complete(reqs, provider=provider, responses=responses)
    summarised = parse_summary(answered).select("repo_id", "path", "description", "imports", "summary_status")
    reused = cur.filter(F.col("change") == "unchanged").select(
        "repo_id", "path", F.col("prev_description").alias("description"),
        F.coalesce(F.col("prev_imports"), F.array().cast("array<string>")).alias("imports"),
        F.lit("reused").alias("summary_status"),
    )
    described = summarised.unionByName(reused)
    processed = cur.join(described, ["repo_id", "path"], "inner").select(
        "repo_id", "path", F.lit("file").alias("kind"), "language", F.lit("").alias("side"), "loc", "imports",
        "description", "sha1", "token_estimate", F.lit(None).cast("bigint").alias("ord"),
        "change", "summary_status", F.col("pos").alias("_order_pos"),
    )
    processed = materialize(processed)
    metadata = upsert_metadata(prev, processed)
    return {"metadata": metadata, "processed": processed, "requests": reqs, "missing": missing}
