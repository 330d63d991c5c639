"""Operator checks over the shared test tables.

Each entry runs a library operator over whole tables (``documents`` stand for
source files via ``documents_as_files``, ``pages`` for web files and URL paths,
``conversations`` for message lists, ``labels`` for previous-run flags,
``events.props`` for JSON answers) and has, where SQL can say the same thing, an
equivalent DuckDB statement.  Answers that a model would give are derived from
the tables by fixed rules so both engines see the same inputs.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codesift.functions import jsonx
from codesift.functions.paths import (EXT_TO_LANG, FLATTEN_EXCLUDE_DIRS, PREFILTER_PATTERN, TREE_EXCLUDE_DIRS,
                                      base_name, detect_language, join_base, normalize_rel, path_parts, relativize)
from codesift.functions.text import decode_ignore, extract_imports, split_lines
from codesift.operators import grouping, locate, metadata, metrics, rules, scan, selection, stages, suggest
from codesift.operators.ordering import head_n, ordinal
from codesift.plans import model
from codesift.plans import prompts as P
from codesift.plans.catalog import DEFAULT_PIPELINES, catalog_frame
from codesift.session import materialize, scratch_path, written
from codesift.sources import artifacts, documents
from codesift.sources.corpus import CORPUS_DIRS, CORPUS_EXTS, DIR_STEP, EXT_STEP, corpus, read_table
from codesift.sources.listing import flatten_tree, scan_corpus, tree_edges
from codesift.streaming.incremental import current_metadata, incremental_metadata

BUNDLE_MAX_CHARS = 20_000
NOT_PRESENT = "☃☃☃"  # a snippet that occurs in no test document

# --------------------------------------------------------------------------- SQL fragments


def _sql_list(xs) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


REPOS = 2  # of the "large repository" corpus: few enough that every cap and chunk size is exceeded at sf 0.01

FILES_SQL = f"""files AS (
  SELECT source AS repo_id,
         'src/' || ({_sql_list(CORPUS_DIRS)})[(doc_id // {DIR_STEP}) % {len(CORPUS_DIRS)} + 1] || '/doc'
           || CAST(doc_id AS VARCHAR) || '.' || ({_sql_list(CORPUS_EXTS)})[(doc_id // {EXT_STEP}) % {len(CORPUS_EXTS)} + 1] AS path,
         text AS content, doc_id
  FROM documents)"""
SCANNED_SQL = f"""scanned AS (
  SELECT * FROM files
  WHERE NOT list_has_any(list_slice(string_split(path, '/'), 1, len(string_split(path, '/')) - 1),
                         {_sql_list(TREE_EXCLUDE_DIRS)}))"""
KEPT_SQL = f"""kept AS (
  SELECT * FROM scanned WHERE NOT regexp_matches(path, {_q('(?i)' + PREFILTER_PATTERN)})
    AND NOT list_has_any(list_slice(string_split(path, '/'), 1, len(string_split(path, '/')) - 1),
                         {_sql_list(FLATTEN_EXCLUDE_DIRS)}))"""
CORPUS_CTES = ",\n".join([FILES_SQL, SCANNED_SQL, KEPT_SQL])
LARGE_FILES_SQL = FILES_SQL.replace("source AS repo_id", f"'repo' || CAST(doc_id % {REPOS} AS VARCHAR) AS repo_id")
LARGE_CTES = ",\n".join([LARGE_FILES_SQL, SCANNED_SQL, KEPT_SQL])


def lang_sql(p: str) -> str:
    sfx = f"regexp_extract({p}, '^(?:.*/)?[^/]+(\\.[^/.]+)$', 1)"
    whens = " ".join(f"WHEN lower({sfx}) = {_q(k)} THEN {_q(v)}" for k, v in EXT_TO_LANG.items())
    return f"(CASE {whens} ELSE substr({sfx}, 2) END)"


def loc_sql(t: str) -> str:
    return f"CAST(length({t}) - length(replace({t}, chr(10), '')) + 1 AS BIGINT)"


def tok_sql(t: str) -> str:
    return f"CAST(floor(length({t}) / 4) + 1 AS BIGINT)"


def first_line_sql(t: str) -> str:
    return f"split_part({t}, chr(10), 1)"


# --------------------------------------------------------------------------- shared fixtures (Spark)


def _files(spark, sf):
    return corpus(spark, sf)


def _large(spark, sf):
    """The same files in a few large repositories."""
    return _files(spark, sf).withColumn("repo_id", F.concat(F.lit("repo"), (F.col("doc_id") % REPOS).cast("string")))


def _keep(files):
    return selection.path_prefilter(selection.flattened(scan_corpus(files)))


def _kept(spark, sf):
    return _keep(_files(spark, sf))


def _with_text(files: DataFrame) -> DataFrame:
    return files.withColumn("text", F.col("content"))


def _repo_no(col="repo_id"):
    return F.regexp_extract(F.col(col), r"(\d+)$", 1).cast("int")


IMPORT_NAMES = [f"mod{i}" for i in range(1, 8)]


def _fixture_metadata(kept: DataFrame) -> DataFrame:
    """Metadata rows for the kept files: the description is the text's hash, and there are 0 to 7 imports."""
    names = F.array(*[F.lit(x) for x in IMPORT_NAMES])
    return kept.select(
        "repo_id", "path", F.lit("file").alias("kind"), detect_language(F.col("path")).alias("language"),
        F.lit("").alias("side"), F.concat(F.lit("text "), F.sha1("content")).alias("description"),
        F.slice(names, 1, (F.col("doc_id") % 8).cast("int")).alias("imports"), F.lit(0).cast("bigint").alias("ord"),
    )


SUBSET_SIZE = 15  # largest subset size the grouping prompt asks for


def _bucketed_subsets(files: DataFrame) -> DataFrame:
    """Subsets of at most 15 files: per repo and language, consecutive paths; numbered per repo
    in (language, bucket) order.  Numbering uses the skew-safe ``ordinal`` and every collected
    list is bounded by the bucket size."""
    k = files.select("repo_id", "path").withColumn("language", detect_language(F.col("path")))
    k = ordinal(k, ["repo_id", "language"], ["path"], "_n").withColumn(
        "bucket", F.floor((F.col("_n") - 1) / SUBSET_SIZE).cast("int"))
    g = k.groupBy("repo_id", "language", "bucket").agg(F.sort_array(F.collect_list("path")).alias("file_paths"))
    g = ordinal(g, ["repo_id"], ["language", "bucket"], "subset_no").withColumn(
        "subset_no", F.col("subset_no").cast("int"))
    return g.select("repo_id", "subset_no", F.format_string(P.SUBSET_ID_FORMAT, F.col("subset_no")).alias("subset_id"),
                    "file_paths", F.concat(F.lit("language "), F.col("language")).alias("reason"))


SUGGEST_ANSWERS = [
    '["pipeline_xss", "pipeline_auth"]',
    '```json\n["pipeline_auth"]\n```',
    '["pipeline_auth", 7, "pipeline_nope"]',
    '[]',
]


def _suggestion_answers(subsets: DataFrame) -> DataFrame:
    ans = F.element_at(F.array(*[F.lit(a) for a in SUGGEST_ANSWERS]), (F.col("subset_no") % 4) + 1)
    return subsets.withColumn("content", ans)


# --------------------------------------------------------------------------- queries

def q_language_profile(spark: SparkSession, sf: str) -> DataFrame:
    """S1 + F1 + F5-F8 + A4: per repo and language, files, lines, tokens and characters kept."""
    p = metadata.profile(_kept(spark, sf))
    return p.groupBy("repo_id", "language").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("loc").cast("bigint").alias("loc"),
        F.sum("token_estimate").cast("bigint").alias("tokens"),
        F.sum(F.length("text")).cast("bigint").alias("chars"),
    )


SQL_LANGUAGE_PROFILE = f"""WITH {CORPUS_CTES}
SELECT repo_id, {lang_sql('path')} AS language, COUNT(*) AS n_files,
       CAST(SUM({loc_sql('content')}) AS BIGINT) AS loc, CAST(SUM({tok_sql('content')}) AS BIGINT) AS tokens,
       CAST(SUM(length(content)) AS BIGINT) AS chars
FROM kept GROUP BY 1, 2"""


def q_file_profile(spark: SparkSession, sf: str) -> DataFrame:
    """F3 F5 F6 F7 F8 per file, with the S1 and F1 decisions as flags."""
    files = _files(spark, sf)
    scanned = scan_corpus(files).select("repo_id", "path", F.lit(True).alias("scanned"))
    p = metadata.profile(files).join(scanned, ["repo_id", "path"], "left")
    return p.select(
        "repo_id", "path", "language", "loc", "token_estimate", "sha1",
        F.coalesce(F.col("scanned"), F.lit(False)).alias("scanned"),
        (F.coalesce(F.col("scanned"), F.lit(False)) & ~selection.path_prefilter_match(F.col("path"))).alias("kept"),
    )


SQL_FILE_PROFILE = f"""WITH {CORPUS_CTES}
SELECT f.repo_id, f.path, {lang_sql('f.path')} AS language, {loc_sql('f.content')} AS loc,
       {tok_sql('f.content')} AS token_estimate, sha1(f.content) AS sha1,
       s.path IS NOT NULL AS scanned,
       s.path IS NOT NULL AND NOT regexp_matches(f.path, {_q('(?i)' + PREFILTER_PATTERN)}) AS kept
FROM files f LEFT JOIN scanned s ON f.repo_id = s.repo_id AND f.path = s.path"""


def q_url_paths(spark: SparkSession, sf: str) -> DataFrame:
    """F2 F3 F4 F5 on the path part of every page URL."""
    pages = read_table(spark, sf, "pages")
    raw = F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    df = pages.select("page_id", raw.alias("raw"))
    return df.select(
        "page_id", "raw",
        normalize_rel(F.col("raw")).alias("norm"),
        F.size(path_parts(F.col("raw"))).cast("bigint").alias("n_parts"),
        base_name(F.col("raw")).alias("name"),
        detect_language(normalize_rel(F.col("raw"))).alias("language"),
        relativize(F.col("raw"), "/en").alias("rel"),
        join_base(F.lit("/srv/www"), F.col("raw")).alias("joined"),
    )


SQL_URL_PATHS = f"""WITH r AS (
  SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS raw FROM pages),
n AS (
  SELECT page_id, raw,
         regexp_replace(regexp_replace(regexp_replace(replace(coalesce(raw, ''), '\\', '/'), '^[A-Za-z]:/', ''),
                        '^/+', ''), '/{{2,}}', '/', 'g') AS norm,
         regexp_replace(raw, '/{{2,}}', '/', 'g') AS p
  FROM r),
x AS (
  SELECT *, list_filter(string_split(norm, '/'), lambda e: e <> '' AND e <> '.') AS parts,
         coalesce(list_filter(string_split(p, '/'), lambda e: e <> '')[-1], '') AS nm
  FROM n)
SELECT page_id, raw, norm, CAST(len(parts) AS BIGINT) AS n_parts,
       coalesce(list_filter(string_split(raw, '/'), lambda e: e <> '')[-1], '') AS name,
       {lang_sql('norm')} AS language,
       CASE WHEN p = '/en' THEN '.'
            WHEN starts_with(p, '/en/') THEN regexp_replace(substr(p, 5), '/+$', '')
            ELSE nm END AS rel,
       CASE WHEN list_contains(parts, '..') THEN NULL
            WHEN len(parts) = 0 THEN '/srv/www'
            ELSE '/srv/www/' || array_to_string(parts, '/') END AS joined
FROM x"""


def q_tree_edges(spark: SparkSession, sf: str) -> DataFrame:
    """The listed tree as parent -> child rows."""
    return tree_edges(scan_corpus(_files(spark, sf))).withColumn("depth", F.col("depth").cast("bigint"))


SQL_TREE_EDGES = f"""WITH {FILES_SQL}, {SCANNED_SQL},
p AS (SELECT repo_id, string_split(path, '/') AS parts FROM scanned)
SELECT repo_id, array_to_string(parts[1:len(parts) - 1], '/') AS parent, parts[len(parts)] AS name,
       'file' AS kind, CAST(len(parts) - 1 AS BIGINT) AS depth FROM p
UNION ALL
SELECT DISTINCT repo_id, array_to_string(parts[1:i - 1], '/') AS parent, parts[i] AS name, 'dir' AS kind,
       CAST(i - 1 AS BIGINT) AS depth
FROM p, LATERAL (SELECT unnest(generate_series(1, len(parts) - 1)) AS i) g"""


def q_selection_requests(spark: SparkSession, sf: str) -> DataFrame:
    """G2 (W3 head-30 + remainder, A1): the original's selection prompt, its limit passed explicitly."""
    r = selection.selection_requests(_keep(_large(spark, sf)), limit=P.SELECT_LIMIT)
    return r.select("repo_id", F.col("n_files").cast("bigint"), F.col("n_offered").cast("bigint"),
                    F.col("messages")[1]["content"].alias("user_prompt"))


SQL_SELECTION_REQUESTS = f"""WITH {LARGE_CTES},
r AS (SELECT repo_id, path, row_number() OVER (PARTITION BY repo_id ORDER BY path) AS rn,
             count(*) OVER (PARTITION BY repo_id) AS n FROM kept)
SELECT repo_id, CAST(max(n) AS BIGINT) AS n_files, CAST(count(*) AS BIGINT) AS n_offered,
       {_q(P.SELECT_PROMPT_HEAD)} || string_agg(path, chr(10) ORDER BY path)
         || CASE WHEN max(n) > count(*) THEN chr(10) || '… and ' || CAST(max(n) - count(*) AS VARCHAR) || ' more files'
                 ELSE '' END AS user_prompt
FROM r WHERE rn <= {P.SELECT_LIMIT} GROUP BY repo_id"""


SELECT_BATCH = 20  # paths per request in the batched queries


def _batch_answers(kept: DataFrame) -> DataFrame:
    """Per request: all its paths as a list, the list fenced, with trailing text, an empty list, a
    list with a number in it, or no answer."""
    lists = selection.selection_batches(kept, SELECT_BATCH).groupBy("repo_id", "batch").agg(
        F.sort_array(F.collect_list("path")).alias("ps"))
    body = F.to_json("ps")
    k = (_repo_no() + F.col("batch")) % 6
    content = (F.when(k == 0, body).when(k == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
               .when(k == 2, F.concat(body, F.lit("]"))).when(k == 3, F.lit("[]"))
               .when(k == 4, F.concat(F.lit('["'), F.col("ps")[0], F.lit('", 1]'))))
    return lists.select("repo_id", "batch", content.alias("content")).filter(F.col("content").isNotNull())


def q_selection_batch_requests(spark: SparkSession, sf: str) -> DataFrame:
    """G2 uncapped: every kept path is offered, in requests of 20."""
    r = selection.selection_requests(_keep(_large(spark, sf)), batch_size=SELECT_BATCH)
    return r.select("repo_id", F.col("batch").cast("bigint"), F.col("n_files").cast("bigint"),
                    F.col("n_offered").cast("bigint"), F.sha1(F.col("messages")[1]["content"]).alias("prompt_sha1"))


_BATCH_SQL = f"""n AS (SELECT repo_id, path, (row_number() OVER (PARTITION BY repo_id ORDER BY path) - 1) // {SELECT_BATCH} + 1 AS batch,
                   count(*) OVER (PARTITION BY repo_id) AS n FROM kept)"""

SQL_SELECTION_BATCH_REQUESTS = f"""WITH {LARGE_CTES}, {_BATCH_SQL}
SELECT repo_id, CAST(batch AS BIGINT) AS batch, CAST(max(n) AS BIGINT) AS n_files, CAST(count(*) AS BIGINT) AS n_offered,
       sha1({_q(P.SELECT_PROMPT_HEAD)} || string_agg(path, chr(10) ORDER BY path)) AS prompt_sha1
FROM n GROUP BY 1, 2"""


def q_selection_batch_result(spark: SparkSession, sf: str) -> DataFrame:
    """G3 per request: the picks of answered requests and all paths of the others, in request order."""
    kept = _keep(_large(spark, sf))
    return selection.batched_selection_result(kept, _batch_answers(kept), SELECT_BATCH)


SQL_SELECTION_BATCH_RESULT = f"""WITH {LARGE_CTES}, {_BATCH_SQL},
k AS (SELECT *, (CAST(regexp_extract(repo_id, '(\\d+)$', 1) AS INTEGER) + batch) % 6 AS k FROM n)
SELECT repo_id, CAST(row_number() OVER (PARTITION BY repo_id ORDER BY path) AS BIGINT) AS pos, path,
       CASE WHEN k IN (0, 1) THEN 'model' ELSE 'fallback' END AS origin
FROM k WHERE k <> 3"""


def _selection_answers(kept: DataFrame) -> DataFrame:
    w = Window.partitionBy("repo_id").orderBy("path")
    top = kept.withColumn("rn", F.row_number().over(w)).filter("rn <= 3")
    lists = top.groupBy("repo_id").agg(F.sort_array(F.collect_list("path")).alias("ps"))
    body = F.concat(F.lit("["), F.array_join(F.transform("ps", lambda p: F.concat(F.lit('"'), p, F.lit('"'))), ","),
                    F.lit("]"))
    k = _repo_no() % 6
    content = (
        F.when(k == 0, body)
        .when(k == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(k == 2, F.concat(body, F.lit(" xx")))
        .when(k == 3, F.lit("[]"))
        .when(k == 4, F.concat(F.lit('["'), F.col("ps")[0], F.lit('", 1]')))
    )
    return lists.select("repo_id", content.alias("content")).filter(F.col("content").isNotNull())


def q_selection_result(spark: SparkSession, sf: str) -> DataFrame:
    """G1/G3 (T4 T5 F14): the model's pick when it is a list of strings, else all pre-filtered files."""
    kept = _kept(spark, sf)
    return selection.selection_result(kept, _selection_answers(kept))


SQL_SELECTION_RESULT = f"""WITH {CORPUS_CTES},
r AS (SELECT repo_id, path, row_number() OVER (PARTITION BY repo_id ORDER BY path) AS rn,
             CAST(regexp_extract(repo_id, '(\\d+)$', 1) AS INTEGER) % 6 AS k FROM kept)
SELECT repo_id, CAST(rn AS BIGINT) AS pos, path, 'model' AS origin FROM r WHERE k IN (0, 1) AND rn <= 3
UNION ALL
SELECT repo_id, CAST(rn AS BIGINT) AS pos, path, 'fallback' AS origin FROM r WHERE k IN (2, 4, 5)"""


def _fixture_selection(spark, sf) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    labels = read_table(spark, sf, "labels")
    repos = docs.select(F.col("source").alias("repo_id")).distinct()
    fixed = repos.select("repo_id", F.lit(1).cast("bigint").alias("pos"), F.lit("./src/models/").alias("path")).unionByName(
        repos.select("repo_id", F.lit(2).cast("bigint").alias("pos"), F.lit("src/ghost.js").alias("path")))
    good = docs.join(labels.filter("quality = 1"), "doc_id").select(
        F.col("source").alias("repo_id"), "doc_id",
        # every other path is written with a leading "./"
        F.concat(F.when(F.col("doc_id") % 2 == 0, "./").otherwise(""), _files_path("doc_id")).alias("path"))
    picked = ordinal(good, ["repo_id"], ["doc_id"], "_n").select(
        "repo_id", (F.col("_n") + 2).cast("bigint").alias("pos"), "path")
    return fixed.unionByName(picked)


def _files_path(col):
    from codesift.sources.corpus import corpus_path
    return corpus_path(F.col(col))


def _fixture_prev(spark, sf) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    labels = read_table(spark, sf, "labels")
    j = ordinal(docs.join(labels, "doc_id"), ["source"], ["doc_id"], "_n")
    return j.select(
        F.col("source").alias("repo_id"), _files_path("doc_id").alias("path"), F.lit("file").alias("kind"),
        detect_language(_files_path("doc_id")).alias("language"), F.lit("").alias("side"),
        F.lit(0).cast("bigint").alias("loc"), F.array(F.lit("old")).alias("imports"),
        F.when(F.col("quality") == 0, F.lit(None).cast("string")).otherwise(F.lit("previous")).alias("description"),
        F.when(F.col("toxic") == 1, F.lit("0" * 40)).otherwise(F.sha1("text")).alias("sha1"),
        F.lit(0).cast("bigint").alias("token_estimate"), F.col("_n").cast("bigint").alias("ord"),
    )


def summary_provider(batches):
    """Deterministic stand-in model for summaries: the summary is the code's hash, the one import
    its number of lines; no JSON when its length is a multiple of 7."""
    import hashlib

    import pandas as pd

    head, tail = P.SUMMARY_PROMPT_HEAD, P.SUMMARY_PROMPT_TAIL
    for pdf in batches:
        out = []
        for rid, msgs in zip(pdf["request_id"], pdf["messages_json"]):
            user = json.loads(msgs)[1]["content"]
            code = user[len(head):len(user) - len(tail)]
            if len(code) % 7 == 0:
                out.append((rid, "not json", "ok"))
            else:
                digest = hashlib.sha1(code.encode()).hexdigest()
                out.append((rid, json.dumps({"summary": "Summary: " + digest, "imports": [str(code.count("\n") + 1)]}), "ok"))
        yield pd.DataFrame(out, columns=["request_id", "content", "status"])


def _build_metadata(spark, sf):
    files = _files(spark, sf)
    return metadata.build_metadata(_fixture_selection(spark, sf), files, _fixture_prev(spark, sf),
                                   provider=summary_provider, max_files=None)


def q_metadata_changes(spark: SparkSession, sf: str) -> DataFrame:
    """G4 (J1 J2 U2 J3 G5 M1): this run's rows: expansion, change status, reuse or new summary."""
    r = _build_metadata(spark, sf)["processed"]
    return r.select("repo_id", "path", "change", "summary_status", "description",
                    F.array_join("imports", ",").alias("imports"), "sha1", "language", "loc", "token_estimate")


_META_SQL = f"""WITH {FILES_SQL},
sel AS (
  SELECT DISTINCT source AS repo_id, CAST(1 AS BIGINT) AS pos, 'src/models' AS path FROM documents
  UNION ALL SELECT DISTINCT source, CAST(2 AS BIGINT), 'src/ghost.js' FROM documents
  UNION ALL SELECT f.repo_id, CAST(row_number() OVER (PARTITION BY f.repo_id ORDER BY f.doc_id) + 2 AS BIGINT), f.path
  FROM files f JOIN labels l ON f.doc_id = l.doc_id WHERE l.quality = 1),
cand AS (
  SELECT s.repo_id, f.path, s.pos, f.path AS sub FROM sel s JOIN files f
    ON f.repo_id = s.repo_id AND starts_with(f.path, s.path || '/')
  UNION ALL
  SELECT s.repo_id, f.path, s.pos, '' AS sub FROM sel s JOIN files f ON f.repo_id = s.repo_id AND f.path = s.path),
exp AS (SELECT repo_id, path, min(pos) AS pos FROM cand GROUP BY 1, 2),
prev AS (
  SELECT f.repo_id, f.path, CASE WHEN l.quality = 0 THEN NULL ELSE 'previous' END AS description,
         CASE WHEN l.toxic = 1 THEN repeat('0', 40) ELSE sha1(f.content) END AS sha1,
         CAST(row_number() OVER (PARTITION BY f.repo_id ORDER BY f.doc_id) AS BIGINT) AS ord
  FROM files f JOIN labels l ON f.doc_id = l.doc_id),
cur AS (
  SELECT e.repo_id, e.path, e.pos, f.content, sha1(f.content) AS sha1, sha1(f.content) AS fl,
         p.path IS NOT NULL AS had_prev, p.sha1 AS prev_sha1, p.description AS prev_description
  FROM exp e JOIN files f ON f.repo_id = e.repo_id AND f.path = e.path
  LEFT JOIN prev p ON p.repo_id = e.repo_id AND p.path = e.path),
ch AS (
  SELECT *, CASE WHEN NOT had_prev THEN 'new'
                 WHEN prev_sha1 IS DISTINCT FROM sha1 OR prev_description IS NULL THEN 'changed'
                 ELSE 'unchanged' END AS change
  FROM cur),
done AS (
  SELECT *, CASE WHEN change = 'unchanged' THEN 'reused' WHEN length(content) % 7 = 0 THEN 'error' ELSE 'ok' END
              AS summary_status FROM ch)"""

SQL_METADATA_CHANGES = _META_SQL + f"""
SELECT repo_id, path, change, summary_status,
       CASE summary_status WHEN 'reused' THEN prev_description WHEN 'ok' THEN 'Summary: ' || fl END AS description,
       CASE summary_status WHEN 'reused' THEN 'old' WHEN 'ok' THEN CAST({loc_sql('content')} AS VARCHAR)
            ELSE '' END AS imports,
       sha1, {lang_sql('path')} AS language, {loc_sql('content')} AS loc, {tok_sql('content')} AS token_estimate
FROM done"""


def q_metadata_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The full table after the run: old rows keep their place, new rows append."""
    m = _build_metadata(spark, sf)["metadata"]
    return m.select("repo_id", "path", "ord", "description", "sha1")


SQL_METADATA_UPSERT = _META_SQL + """,
mx AS (SELECT repo_id, max(ord) AS m FROM prev GROUP BY 1)
SELECT p.repo_id, p.path, p.ord,
       CASE WHEN d.path IS NULL THEN p.description
            WHEN d.summary_status = 'reused' THEN d.prev_description
            WHEN d.summary_status = 'ok' THEN 'Summary: ' || d.fl END AS description,
       coalesce(d.sha1, p.sha1) AS sha1
FROM prev p LEFT JOIN done d ON d.repo_id = p.repo_id AND d.path = p.path
UNION ALL
SELECT d.repo_id, d.path,
       CAST(coalesce(mx.m, 0) + row_number() OVER (PARTITION BY d.repo_id ORDER BY d.pos, d.path) AS BIGINT) AS ord,
       CASE WHEN d.summary_status = 'ok' THEN 'Summary: ' || d.fl END AS description, d.sha1
FROM done d LEFT JOIN mx ON mx.repo_id = d.repo_id WHERE NOT d.had_prev"""


def q_grouping_requests(spark: SparkSession, sf: str) -> DataFrame:
    """G6 (W1 T8 A1): grouping prompt per chunk of 60 metadata entries, all imports shown."""
    r = grouping.grouping_requests(_fixture_metadata(_keep(_large(spark, sf))))
    return r.select("repo_id", F.col("chunk").cast("bigint"), F.col("n_entries").cast("bigint"), "files_block",
                    F.sha1(F.col("messages")[1]["content"]).alias("prompt_sha1"))


_FIXTURE_META_SQL = f"""fm AS (
  SELECT repo_id, path, {lang_sql('path')} AS language, 'text ' || sha1(content) AS description,
         list_slice({_sql_list(IMPORT_NAMES)}, 1, doc_id % 8) AS imports
  FROM kept)"""

SQL_GROUPING_REQUESTS = f"""WITH {LARGE_CTES}, {_FIXTURE_META_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY repo_id ORDER BY path) AS k FROM fm),
c AS (SELECT *, CAST(floor((k - 1) / {P.FILES_PER_GROUPING_PROMPT}) + 1 AS BIGINT) AS chunk,
             '- ' || path || ' [/' || language || ']: ' || description
             || CASE WHEN array_to_string(imports, ', ') <> ''
                     THEN ' | Imports: ' || array_to_string(imports, ', ') ELSE '' END
             AS line
      FROM r)
SELECT repo_id, chunk, CAST(count(*) AS BIGINT) AS n_entries, string_agg(line, chr(10) ORDER BY k) AS files_block,
       sha1({_q(P.GROUP_INSTRUCTIONS + P.GROUP_FILES_HEADER)} || string_agg(line, chr(10) ORDER BY k)) AS prompt_sha1
FROM c GROUP BY 1, 2"""


def _grouping_answers(meta: DataFrame) -> DataFrame:
    chunks = grouping.assign_chunks(meta)
    by_lang = chunks.groupBy("repo_id", "chunk", "language").agg(F.sort_array(F.collect_list("path")).alias("fps"))
    obj = F.to_json(F.struct(F.col("language").alias("subset_id"), F.col("fps").alias("file_paths"),
                             F.concat(F.lit("language "), F.col("language")).alias("reason")))
    lists = by_lang.withColumn("obj", obj).groupBy("repo_id", "chunk").agg(
        F.concat(F.lit("["), F.expr("listagg(obj, ',') WITHIN GROUP (ORDER BY language)"), F.lit("]")).alias("body"))
    k = (_repo_no() + F.col("chunk")) % 3
    content = (F.when(k == 0, F.concat(F.lit("```json\n"), F.col("body"), F.lit("\n```")))
               .when(k == 1, F.col("body"))
               .otherwise(F.concat(F.col("body"), F.lit("]"))))
    return lists.select("repo_id", "chunk", content.alias("content"))


def q_grouping_parse(spark: SparkSession, sf: str) -> DataFrame:
    """G7 (F15 T4 W2): subsets from fenced / bare / broken answers, renumbered per repo."""
    res = grouping.parse_grouping(_grouping_answers(_fixture_metadata(_keep(_large(spark, sf)))))
    s = res["subsets"]
    return s.select("repo_id", "subset_no", "subset_id", "chunk_subset_id",
                    F.size("file_paths").cast("bigint").alias("n_files"),
                    F.array_join("file_paths", ",").alias("paths"), "reason")


SQL_GROUPING_PARSE = f"""WITH {LARGE_CTES},
c AS (SELECT *, (row_number() OVER (PARTITION BY repo_id ORDER BY path) - 1) // {P.FILES_PER_GROUPING_PROMPT} + 1 AS chunk FROM kept),
g AS (SELECT repo_id, chunk, {lang_sql('path')} AS language, string_agg(path, ',' ORDER BY path) AS paths,
             count(*) AS n FROM c GROUP BY 1, 2, 3),
r AS (SELECT *, (CAST(regexp_extract(repo_id, '(\\d+)$', 1) AS INTEGER) + chunk) % 3 AS k FROM g)
SELECT repo_id, CAST(row_number() OVER (PARTITION BY repo_id ORDER BY chunk, language) AS BIGINT) AS subset_no,
       printf('subset-%03d', row_number() OVER (PARTITION BY repo_id ORDER BY chunk, language)) AS subset_id,
       printf('%s-chunk%02d', language, chunk) AS chunk_subset_id, CAST(n AS BIGINT) AS n_files, paths, 'language ' || language AS reason
FROM r WHERE k IN (0, 1)"""


def q_suggestion_requests(spark: SparkSession, sf: str) -> DataFrame:
    """P1/P2 (J5 T9 T10 A6): subset summary (the original's cap of 8 passed explicitly, + omission line)
    inside the suggestion request.  Subsets cover all listed files, so many have no metadata."""
    large = _large(spark, sf)
    subsets = _bucketed_subsets(scan_corpus(large))
    r = suggest.suggestion_requests(subsets, _fixture_metadata(_keep(large)), catalog_frame(spark), cap=P.FILES_PER_SUGGESTION)
    sizes = suggest.subset_sizes(subsets)
    return r.join(sizes, ["repo_id", "subset_id"]).select(
        "repo_id", "subset_id", "summary", "n_files", F.sha1(F.col("messages")[0]["content"]).alias("system_sha1"),
        F.sha1(F.col("messages")[1]["content"]).alias("user_sha1"))


def q_suggestion_requests_whole(spark: SparkSession, sf: str) -> DataFrame:
    """P1/P2 uncapped: every path of a subset is described."""
    large = _large(spark, sf)
    r = suggest.suggestion_requests(_bucketed_subsets(scan_corpus(large)), _fixture_metadata(_keep(large)), catalog_frame(spark))
    return r.select("repo_id", "subset_id", "summary")


def _catalog_text_py() -> str:
    return "\n".join(f"- {p['pipeline_id']}: {p['description']} (targets {', '.join(p['target_vulnerabilities'])})"
                     for p in DEFAULT_PIPELINES)


_SUGGEST_SQL = f"""WITH {LARGE_CTES}, {_FIXTURE_META_SQL},
b AS (SELECT *, (row_number() OVER (PARTITION BY repo_id, language ORDER BY path) - 1) // {SUBSET_SIZE} AS bucket
      FROM (SELECT repo_id, path, {lang_sql('path')} AS language FROM scanned)),
g AS (SELECT repo_id, language, bucket, list(path ORDER BY path) AS fps FROM b GROUP BY 1, 2, 3),
s AS (SELECT *, printf('subset-%03d', row_number() OVER (PARTITION BY repo_id ORDER BY language, bucket)) AS subset_id
      FROM g),
m AS (SELECT s.repo_id, s.subset_id, len(s.fps) AS n, u.i, s.fps[u.i] AS path
      FROM s, LATERAL (SELECT unnest(generate_series(1, len(s.fps))) AS i) u),
lines AS (SELECT m.repo_id, m.subset_id, m.n, m.i, '• ' || m.path || ' [/' || coalesce(fm.language, '') || ']: '
                 || coalesce(fm.description, '') AS line
          FROM m LEFT JOIN fm ON fm.repo_id = m.repo_id AND fm.path = m.path)"""

SQL_SUGGESTION_REQUESTS = _SUGGEST_SQL + f""",
x AS (SELECT repo_id, subset_id, max(n) AS n_files, string_agg(line, chr(10) ORDER BY i) FILTER (i <= {P.FILES_PER_SUGGESTION})
         || CASE WHEN max(n) > {P.FILES_PER_SUGGESTION}
                 THEN chr(10) || '… ' || CAST(max(n) - {P.FILES_PER_SUGGESTION} AS VARCHAR)
                      || ' more files omitted for brevity …' ELSE '' END AS summary
      FROM lines GROUP BY 1, 2)
SELECT repo_id, subset_id, summary, CAST(n_files AS BIGINT) AS n_files,
       sha1({_q(P.SUGGEST_SYSTEM_HEAD + _catalog_text_py() + P.SUGGEST_SYSTEM_TAIL)}) AS system_sha1,
       sha1({_q(P.SUGGEST_USER_HEAD)} || summary || {_q(P.SUGGEST_USER_TAIL)}) AS user_sha1
FROM x"""

SQL_SUGGESTION_REQUESTS_WHOLE = _SUGGEST_SQL + """
SELECT repo_id, subset_id, string_agg(line, chr(10) ORDER BY i) AS summary FROM lines GROUP BY 1, 2"""


def q_suggestion_parse(spark: SparkSession, sf: str) -> DataFrame:
    """List -> its strings, anything else -> the injection pipeline."""
    p = suggest.parse_suggestions(_suggestion_answers(_bucketed_subsets(_kept(spark, sf))))
    return p.select("repo_id", "subset_id", F.array_join("suggested_pipelines", ",").alias("suggested"))


_FIXTURE_SUBSETS_SQL = f"""sb AS (
  SELECT repo_id, path, {lang_sql('path')} AS language FROM kept),
sg AS (
  SELECT repo_id, language, bucket, list(path ORDER BY path) AS fps
  FROM (SELECT *, (row_number() OVER (PARTITION BY repo_id, language ORDER BY path) - 1) // {SUBSET_SIZE} AS bucket
        FROM sb) GROUP BY 1, 2, 3),
ss AS (SELECT repo_id, fps, row_number() OVER (PARTITION BY repo_id ORDER BY language, bucket) AS subset_no FROM sg),
sug AS (SELECT repo_id, subset_no, printf('subset-%03d', subset_no) AS subset_id, fps,
               CASE subset_no % 4 WHEN 0 THEN ['pipeline_xss', 'pipeline_auth'] WHEN 1 THEN ['pipeline_injection']
                    WHEN 2 THEN ['pipeline_auth', 'pipeline_nope'] ELSE [] END AS suggested
        FROM ss)"""

SQL_SUGGESTION_PARSE = f"""WITH {CORPUS_CTES}, {_FIXTURE_SUBSETS_SQL}
SELECT repo_id, subset_id, array_to_string(suggested, ',') AS suggested FROM sug"""


def _plan(spark, sf) -> DataFrame:
    subsets = _bucketed_subsets(_kept(spark, sf))
    sugg = suggest.parse_suggestions(_suggestion_answers(subsets)).select(
        "repo_id", "subset_id", "subset_no", "suggested_pipelines")
    return scan.plan_runs(sugg, subsets, catalog_frame(spark))


def q_run_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Suggestions x subsets x catalog (broadcast), unknown ids reported."""
    p = _plan(spark, sf)
    return p.select("repo_id", "subset_id", F.col("pipeline_pos").cast("bigint"), "pipeline_id",
                    F.col("stage.id").alias("stage_id"), F.size("file_paths").cast("bigint").alias("n_files"),
                    "plan_status")


_PLAN_SQL = f"""cat AS (SELECT * FROM (VALUES {", ".join(f"({_q(p['pipeline_id'])}, {_q(p['stages'][0]['id'])})" for p in DEFAULT_PIPELINES)}) t(pipeline_id, stage_id)),
plan AS (
  SELECT s.repo_id, s.subset_id, s.subset_no, s.fps, CAST(u.i - 1 AS BIGINT) AS pipeline_pos, s.suggested[u.i] AS pipeline_id
  FROM sug s, LATERAL (SELECT unnest(generate_series(1, len(s.suggested))) AS i) u)"""

SQL_RUN_PLAN = f"""WITH {CORPUS_CTES}, {_FIXTURE_SUBSETS_SQL}, {_PLAN_SQL}
SELECT p.repo_id, p.subset_id, p.pipeline_pos, p.pipeline_id, c.stage_id, CAST(len(p.fps) AS BIGINT) AS n_files,
       CASE WHEN c.pipeline_id IS NULL THEN 'unknown_pipeline' ELSE 'ok' END AS plan_status
FROM plan p LEFT JOIN cat c ON c.pipeline_id = p.pipeline_id"""


BUNDLE_CHUNK = 20  # documents per bundled subset


def q_context_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """A2: every 20 consecutive documents of a repo (doc_id order) as one subset, bundled whole."""
    return _bundles(spark, sf, None)


def q_context_bundle_cut(spark: SparkSession, sf: str) -> DataFrame:
    """A2 + W4: the same subsets with a limit passed explicitly."""
    return _bundles(spark, sf, BUNDLE_MAX_CHARS)


def _bundles(spark: SparkSession, sf: str, max_chars: int | None) -> DataFrame:
    docs = _files(spark, sf)
    n = ordinal(docs.select("repo_id", "path", "doc_id"), ["repo_id"], ["doc_id"], "_n")
    n = n.withColumn("chunk", F.floor((F.col("_n") - 1) / BUNDLE_CHUNK).cast("bigint"))
    subsets = n.groupBy("repo_id", "chunk").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "path"))), lambda x: x["path"]).alias("file_paths")
    ).select("repo_id", F.format_string("chunk-%d", F.col("chunk")).alias("subset_id"), "file_paths")
    b = scan.bundle_context(subsets, _with_text(docs), max_chars=max_chars)
    return b.select("repo_id", "subset_id", "n_parts", F.length("bundle").cast("bigint").alias("bundle_chars"),
                    F.sha1("bundle").alias("bundle_sha1"))


def _part_sql(p: str, t: str) -> str:
    return (f"(chr(10) || '=====' || chr(10) || 'FILE: ' || {p} || chr(10) || '=====' || chr(10) || {t} || chr(10)"
            f" || '=====' || chr(10) || 'END OF FILE: ' || {p} || chr(10) || '=====' || chr(10))")


SQL_CONTEXT_BUNDLE = f"""WITH {FILES_SQL},
parts AS (SELECT repo_id, doc_id, {_part_sql('path', 'content')} AS part,
                 (row_number() OVER (PARTITION BY repo_id ORDER BY doc_id) - 1) // {BUNDLE_CHUNK} AS chunk FROM files),
b AS (SELECT repo_id, chunk, CAST(count(*) AS BIGINT) AS n_parts, string_agg(part, chr(10) ORDER BY doc_id) AS bundle
      FROM parts GROUP BY 1, 2)
SELECT repo_id, 'chunk-' || CAST(chunk AS VARCHAR) AS subset_id, n_parts, CAST(length(bundle) AS BIGINT) AS bundle_chars,
       sha1(bundle) AS bundle_sha1 FROM b"""

SQL_CONTEXT_BUNDLE_CUT = f"""WITH {FILES_SQL},
parts AS (SELECT repo_id, doc_id, {_part_sql('path', 'content')} AS part,
                 (row_number() OVER (PARTITION BY repo_id ORDER BY doc_id) - 1) // {BUNDLE_CHUNK} AS chunk FROM files),
st AS (SELECT *, coalesce(sum(length(part) + 1) OVER (PARTITION BY repo_id, chunk ORDER BY doc_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM parts),
b AS (SELECT repo_id, chunk, CAST(count(*) AS BIGINT) AS n_parts,
             left(string_agg(part, chr(10) ORDER BY doc_id), {BUNDLE_MAX_CHARS}) AS bundle
      FROM st WHERE start <= {BUNDLE_MAX_CHARS} GROUP BY 1, 2)
SELECT repo_id, 'chunk-' || CAST(chunk AS VARCHAR) AS subset_id, n_parts, CAST(length(bundle) AS BIGINT) AS bundle_chars,
       sha1(bundle) AS bundle_sha1 FROM b"""


def q_scan_requests(spark: SparkSession, sf: str) -> DataFrame:
    """E1 (A2 uncut): auditor request per (subset, pipeline)."""
    plan = _plan(spark, sf).filter(F.col("plan_status") == "ok")
    b = scan.bundle_context(plan.select("repo_id", "subset_id", "file_paths").distinct(), _with_text(_kept(spark, sf)))
    r = scan.scan_requests(plan, b)
    return r.select("repo_id", "subset_id", "pipeline_id", "operation",
                    F.sha1(F.col("messages")[0]["content"]).alias("system_sha1"),
                    F.sha1(F.col("messages")[1]["content"]).alias("user_sha1"), "params_json")


def _system_sql() -> str:
    whens = []
    for p in DEFAULT_PIPELINES:
        st = p["stages"][0]
        text = P.SCAN_SYSTEM_HEAD + st["prompt_template"] + P.SCAN_SCHEMA_TEXT + P.SCAN_EXAMPLE_HEAD + json.dumps(
            st["example"], indent=2)
        whens.append(f"WHEN {_q(p['pipeline_id'])} THEN {_q(text)}")
    return "CASE pipeline_id " + " ".join(whens) + " END"


SQL_SCAN_REQUESTS = f"""WITH {CORPUS_CTES}, {_FIXTURE_SUBSETS_SQL}, {_PLAN_SQL},
ok AS (SELECT p.* , c.stage_id FROM plan p JOIN cat c ON c.pipeline_id = p.pipeline_id),
m AS (SELECT DISTINCT s.repo_id, s.subset_id, u.i, s.fps[u.i] AS path
      FROM sug s, LATERAL (SELECT unnest(generate_series(1, len(s.fps))) AS i) u),
b AS (SELECT m.repo_id, m.subset_id, string_agg({_part_sql('m.path', 'k.content')}, chr(10) ORDER BY m.i) AS bundle
      FROM m JOIN kept k ON k.repo_id = m.repo_id AND k.path = m.path GROUP BY 1, 2)
SELECT ok.repo_id, ok.subset_id, ok.pipeline_id, {_q(P.OP_STAGE_PREFIX)} || ok.stage_id AS operation,
       sha1({_system_sql()}) AS system_sha1,
       sha1({_q(P.SCAN_USER_HEAD)} || b.bundle || {_q(P.SCAN_USER_TAIL)}) AS user_sha1,
       '{{"model":"gpt-4o","max_tokens":720,"response_format":{{"type":"json_object"}}}}' AS params_json
FROM ok JOIN b ON b.repo_id = ok.repo_id AND b.subset_id = ok.subset_id"""


def _stage(name: str, out: str, inp: str | None = None) -> dict:
    return {"id": name, "title": name, "prompt_template": f"Report for {name}.", "inject_previous_output": inp is not None,
            "input_tag": inp, "save_output": True, "output_tag": out, "example": []}


#: Pipelines of several stages: detect and remediate; an input that nobody saves, with a stage behind it; a cycle.
STAGED_PIPELINES = [
    {"pipeline_id": "pipeline_xss", "stages": [_stage("detect", "detected"), _stage("mend", "mended", "detected")]},
    {"pipeline_id": "pipeline_auth", "stages": [_stage("mend", "mended", "lost"), _stage("rank", "ranked", "mended"), _stage("detect", "detected")]},
    {"pipeline_id": "pipeline_injection", "stages": [_stage("there", "x", "y"), _stage("back", "y", "x")]},
]


STAGE_INPUT_HEAD = stages.INPUT_HEAD


def staged_provider(batches):
    """The stored answers: detection names the first file of its bundle, the next stage appends a remediation."""
    import json as _json

    import pandas as pd

    for pdf in batches:
        out = []
        for text in pdf["messages_json"]:
            user = _json.loads(text)[1]["content"]
            injected = STAGE_INPUT_HEAD in user
            first = user.split("FILE: ")[1].split("\n")[0]
            row = {"file_path": first, "severity": "High"} | ({"remediation": "Use parameters."} if injected else {})
            out.append(_json.dumps({"vulnerabilities": [row]}))
        yield pd.DataFrame({"request_id": pdf["request_id"], "content": out, "status": "ok"})


def q_stage_graph(spark: SparkSession, sf: str) -> DataFrame:
    """K2 (E1 E2 M1 reused): every planned stage of every subset with its level and status, the digest of its request and what
    it found, replayed from stored answers."""
    subsets = _bucketed_subsets(_kept(spark, sf))
    catalog = catalog_frame(spark, STAGED_PIPELINES)
    files = _with_text(_kept(spark, sf))
    sugg = suggest.parse_suggestions(_suggestion_answers(subsets)).select("repo_id", "subset_id", "subset_no", "suggested_pipelines")
    plan = materialize(scan.plan_runs(sugg, subsets, catalog))
    stored = stages.run_stages(plan, catalog, files, provider=staged_provider)["responses"]
    run = stages.run_stages(plan, catalog, files, responses=stored)
    told = run["requests"].select("repo_id", "subset_id", "pipeline_id", "stage_no", F.sha1(F.col("messages")[1]["content"]).alias("user_sha1"))
    found = run["findings"].select("repo_id", "subset_id", "pipeline_id", "stage_no", "file_path", "remediation")
    keys = ["repo_id", "subset_id", "pipeline_id", "stage_no"]
    return run["stages"].drop("request_id").join(told, keys, "left").join(found, keys, "left").select(
        "repo_id", "subset_id", "pipeline_id", F.col("stage_no").cast("bigint"), "stage_id", F.col("level").cast("bigint"),
        "stage_status", "user_sha1", "file_path", "remediation")


SQL_STAGE_GRAPH = f"""WITH RECURSIVE {CORPUS_CTES}, {_FIXTURE_SUBSETS_SQL}, {_PLAN_SQL},
st AS (SELECT * FROM (VALUES {", ".join(f"({_q(p['pipeline_id'])}, {i}, {_q(x['id'])}, {_q(x['output_tag'])}, {_q(x['input_tag']) if x['input_tag'] else 'NULL'})" for p in STAGED_PIPELINES for i, x in enumerate(p['stages']))}) t(pipeline_id, stage_no, stage_id, output_tag, input_tag)),
edge AS (SELECT s.*, (SELECT max(p.stage_no) FROM st p WHERE p.pipeline_id = s.pipeline_id AND p.output_tag = s.input_tag) AS producer_no FROM st s),
walk AS (SELECT pipeline_id, stage_no, 0 AS level, CASE WHEN input_tag IS NULL THEN 'ok' ELSE 'unknown_tag' END AS stage_status
         FROM edge WHERE producer_no IS NULL
         UNION ALL SELECT e.pipeline_id, e.stage_no, w.level + 1, CASE w.stage_status WHEN 'ok' THEN 'ok' ELSE 'blocked' END
         FROM edge e JOIN walk w ON w.pipeline_id = e.pipeline_id AND w.stage_no = e.producer_no),
g AS (SELECT e.*, CASE WHEN w.stage_status = 'ok' THEN w.level END AS level, coalesce(w.stage_status, 'cycle') AS stage_status,
             EXISTS (SELECT 1 FROM edge c WHERE c.pipeline_id = e.pipeline_id AND c.producer_no = e.stage_no) AS is_read
      FROM edge e LEFT JOIN walk w ON w.pipeline_id = e.pipeline_id AND w.stage_no = e.stage_no),
m AS (SELECT DISTINCT s.repo_id, s.subset_id, u.i, s.fps[u.i] AS path
      FROM sug s, LATERAL (SELECT unnest(generate_series(1, len(s.fps))) AS i) u),
b AS (SELECT m.repo_id, m.subset_id, string_agg({_part_sql('m.path', 'k.content')}, chr(10) ORDER BY m.i) AS bundle
      FROM m JOIN kept k ON k.repo_id = m.repo_id AND k.path = m.path GROUP BY 1, 2)
SELECT p.repo_id, p.subset_id, p.pipeline_id, CAST(g.stage_no AS BIGINT) AS stage_no, g.stage_id, CAST(g.level AS BIGINT) AS level, g.stage_status,
       CASE WHEN g.level = 0 THEN sha1({_q(P.SCAN_USER_HEAD)} || b.bundle || {_q(P.SCAN_USER_TAIL)})
            WHEN g.level = 1 THEN sha1({_q(P.SCAN_USER_HEAD)} || b.bundle || {_q(P.SCAN_USER_TAIL)} || {_q(stages.INPUT_HEAD)} || g.input_tag
              || {_q(stages.INPUT_MID)} || '{{"vulnerabilities":[{{"file_path":"' || p.fps[1] || '","severity":"High"}}]}}' || {_q(stages.INPUT_TAIL)}) END AS user_sha1,
       CASE WHEN g.level IS NOT NULL AND NOT g.is_read THEN p.fps[1] END AS file_path,
       CASE WHEN g.level = 1 THEN 'Use parameters.' END AS remediation
FROM plan p JOIN g ON g.pipeline_id = p.pipeline_id LEFT JOIN b ON b.repo_id = p.repo_id AND b.subset_id = p.subset_id"""


def _findings_answers(plan: DataFrame, kept: DataFrame) -> DataFrame:
    """Answers in five forms; those with findings name every file of the subset, the first of them also in a row that
    breaks the contract."""
    keys = ["repo_id", "subset_id", "subset_no", "pipeline_pos", "pipeline_id"]
    members = plan.select("repo_id", "subset_id", F.col("suggestion_no").alias("subset_no"), "pipeline_pos", "pipeline_id",
                          F.posexplode("file_paths").alias("i", "fp"))
    j = members.join(kept.select("repo_id", F.col("path").alias("fp"), "content"), ["repo_id", "fp"], "inner")
    snippet = F.substring_index(F.col("content"), "\n", 1)
    row = F.to_json(F.struct(F.col("fp").alias("file_path"), snippet.alias("code_snippet"),
                             F.lit("Input reaches a query.").alias("description"),
                             F.lit("SQL Injection").alias("vulnerability"), F.lit("High").alias("severity"),
                             F.lit("High").alias("confidence_level"), F.lit("Use parameters.").alias("remediation")))
    j = j.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "fp", row.alias("row")))).alias("rows"))
    f1 = F.array_join(F.transform("rows", lambda x: x["row"]), ", ")
    f2 = F.to_json(F.struct(F.col("rows")[0]["fp"].alias("file_path"), F.lit("Weak check.").alias("description"),
                            F.lit("Broken Auth").alias("vulnerability"), F.lit("Severe").alias("severity"),
                            F.lit("Low").alias("confidence_level")))
    k = (F.col("subset_no") + F.col("pipeline_pos")) % 5
    content = (
        F.when(k == 0, F.concat(F.lit('{"vulnerabilities": ['), f1, F.lit(", "), f2, F.lit("]}")))
        .when(k == 1, F.concat(F.lit("["), f1, F.lit("]")))
        .when(k == 2, F.lit("Sorry, I cannot help with that."))
        .when(k == 3, F.lit('{"result": []}'))
        .otherwise(F.concat(F.lit('{"vulnerabilities": ['), f1, F.lit(', "oops"]}')))
    )
    return j.select("repo_id", "subset_id", "pipeline_pos", "pipeline_id",
                    F.concat_ws(":", "repo_id", "subset_id", "pipeline_id").alias("request_id"), content.alias("content"))


def q_findings_parse(spark: SparkSession, sf: str) -> DataFrame:
    """E2 + K1: findings out of wrapped / bare / non-JSON / keyless answers, contract violations reported."""
    plan = _plan(spark, sf).filter(F.col("plan_status") == "ok")
    ans = _findings_answers(plan, _kept(spark, sf))
    f = scan.check_findings(scan.parse_findings(ans)["findings"])
    return f.select("repo_id", "subset_id", "pipeline_id", "pos", "file_path", "code_snippet", "severity",
                    F.array_join("violations", ",").alias("violations"))


SQL_FINDINGS_PARSE = f"""WITH {CORPUS_CTES}, {_FIXTURE_SUBSETS_SQL}, {_PLAN_SQL},
ok AS (SELECT p.*, (p.subset_no + p.pipeline_pos) % 5 AS k FROM plan p JOIN cat c ON c.pipeline_id = p.pipeline_id),
m AS (SELECT ok.*, u.i, ok.fps[u.i] AS path FROM ok, LATERAL (SELECT unnest(generate_series(1, len(ok.fps))) AS i) u)
SELECT m.repo_id, subset_id, pipeline_id, CAST(i - 1 AS BIGINT) AS pos, m.path AS file_path,
       {first_line_sql('content')} AS code_snippet, 'High' AS severity, '' AS violations
FROM m JOIN kept ON kept.repo_id = m.repo_id AND kept.path = m.path WHERE k IN (0, 1, 4)
UNION ALL
SELECT repo_id, subset_id, pipeline_id, CAST(len(fps) AS BIGINT), fps[1], NULL, 'Severe',
       'missing:remediation,bad_enum:severity'
FROM ok WHERE k = 0"""


SCAN_ROOT = "/work/src"


def _scan_answers(plan: DataFrame, files: DataFrame) -> DataFrame:
    """Stored answers that report every file of a subset: by turns its first line, a snippet that is nowhere, a line list
    without a snippet, and its first two lines."""
    members = plan.select("repo_id", "subset_id", "pipeline_id", F.posexplode("file_paths").alias("i", "path"))
    lines = F.slice(split_lines(F.col("content")), 1, 2)
    j = members.join(files.select("repo_id", "path", "content"), ["repo_id", "path"])
    snippet = F.when(F.col("i") % 4 == 0, F.get(lines, 0)).when(F.col("i") % 4 == 1, F.lit(NOT_PRESENT)) \
        .when(F.col("i") % 4 == 3, F.array_join(lines, "\n"))
    row = F.to_json(F.struct(F.concat(F.lit(SCAN_ROOT + "/"), "path").alias("file_path"), snippet.alias("code_snippet"),
                             F.lit("High").alias("severity"), F.when(F.col("i") % 4 == 2, F.array(F.lit(3), F.lit(4))).alias("line")))
    rows = F.transform(F.sort_array(F.collect_list(F.struct("i", row.alias("row")))), lambda x: x["row"])
    return j.groupBy("repo_id", "subset_id", "pipeline_id").agg(
        F.concat(F.lit('{"vulnerabilities": ['), F.array_join(rows, ", "), F.lit("]}")).alias("content"))


def q_run_scan(spark: SparkSession, sf: str) -> DataFrame:
    """L2 (E1 M1 E2 L1 F2 F12 U1): a full scan replayed from stored answers for every file of each subset; findings with
    their lines, and per repo how many were removed because they have none."""
    files = _with_text(_kept(spark, sf))
    plan = materialize(_plan(spark, sf).filter(F.col("plan_status") == "ok"))
    bundles = scan.bundle_context(plan.select("repo_id", "subset_id", "file_paths").distinct(), files, root=SCAN_ROOT)
    asked = scan.scan_requests(plan, bundles).select("repo_id", "subset_id", "pipeline_id", "request_id")
    stored = asked.join(_scan_answers(plan, files), ["repo_id", "subset_id", "pipeline_id"]).select(
        "request_id", "content", F.lit("ok").alias("status"))
    out = scan.run_scan(plan, files, responses=stored, root=SCAN_ROOT)
    found = out["findings"].select("repo_id", "subset_id", "pipeline_id", "pos", "file_path",
                                   F.col("line")[0].cast("bigint").alias("start"), F.size("line").cast("bigint").alias("n_lines"))
    none = F.lit(None).cast("string")
    return found.unionByName(out["removed"].select(
        "repo_id", none.alias("subset_id"), none.alias("pipeline_id"), F.col("n_removed").alias("pos"), F.lit("(removed)").alias("file_path"),
        F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("n_lines")))


def _locate_findings(spark, sf) -> DataFrame:
    """One finding per document: its line number ``doc_id % n + 1`` (every test document has
    text), with ``first_equal``, the first line whose collapsed text is the same (the
    line an exact search must report)."""
    files = _files(spark, sf)
    # out of a generator the lines are a column, split once
    lines = files.select("doc_id", "repo_id", "path", F.explode_outer(F.array(split_lines(F.col("content")))).alias("lines"))
    pick = (F.col("doc_id") % F.size("lines")).cast("int") + 1
    norms = F.transform("lines", locate.collapse_ws)
    return lines.withColumn("line_text", F.try_element_at("lines", pick)).select(
        F.col("doc_id").cast("string").alias("finding_id"), "repo_id", "path", "doc_id", "line_text",
        F.array_position(norms, locate.collapse_ws(F.col("line_text"))).cast("int").alias("first_equal"),
    )


def q_locate_exact(spark: SparkSession, sf: str) -> DataFrame:
    """L1 (T1 T2 W5 A3 J7 T12): of every document one line and one run of two to five lines located back."""
    files = _with_text(_files(spark, sf))
    one = _locate_findings(spark, sf).select("finding_id", "repo_id", "path", "doc_id", F.col("line_text").alias("snippet"))
    lines = files.select("doc_id", "repo_id", "path", F.explode_outer(F.array(split_lines(F.col("content")))).alias("lines"))
    size = (F.col("doc_id") % 4 + 2).cast("int")
    begin = (F.col("doc_id") % (F.size("lines") - size + 1) + 1).cast("int")
    many = lines.filter(F.size("lines") >= size).select(
        F.concat(F.col("doc_id").cast("string"), F.lit("m")).alias("finding_id"), "repo_id", "path", "doc_id",
        F.array_join(F.slice("lines", begin, size), "\n").alias("snippet"))
    f = written(one.unionByName(many), "located-findings")
    loc = locate.locate_snippets(f.select("finding_id", "repo_id", "path", "snippet"), files)
    return f.join(loc, "finding_id").select(
        "finding_id", F.col("start").cast("bigint"), F.col("end").cast("bigint"), F.size("line").cast("bigint").alias("n_lines"))


_LINES_SQL = f"""{FILES_SQL},
ls AS (SELECT f.doc_id, f.repo_id, f.path, u.i AS line_no, u.l AS line, len(string_split(f.content, chr(10))) AS n0,
              string_split(f.content, chr(10)) AS arr
       FROM files f, LATERAL (SELECT unnest(string_split(f.content, chr(10))) AS l,
                                     unnest(generate_series(1, len(string_split(f.content, chr(10))))) AS i) u),
lines AS (SELECT *, CASE WHEN arr[n0] = '' THEN n0 - 1 ELSE n0 END AS n FROM ls),
lines2 AS (SELECT * FROM lines WHERE line_no <= n),
pick AS (SELECT DISTINCT doc_id, repo_id, path, n, arr[doc_id % n + 1] AS snippet FROM lines2),
hit AS (SELECT p.doc_id, min(l.line_no) AS start
        FROM pick p JOIN lines2 l ON l.doc_id = p.doc_id
         AND trim(regexp_replace(l.line, '\\s+', ' ', 'g')) = trim(regexp_replace(p.snippet, '\\s+', ' ', 'g'))
        GROUP BY 1)"""

_WINDOWS_SQL = _LINES_SQL + """,
texts AS (SELECT DISTINCT doc_id, n, arr FROM lines2),
win AS (SELECT l.doc_id, w.w, l.line_no AS s,
               trim(regexp_replace(array_to_string(list_slice(l.arr, l.line_no, l.line_no + w.w - 1), ' '), '\\s+', ' ', 'g')) AS t
        FROM lines2 l, (SELECT unnest(generate_series(1, 5)) AS w) w WHERE l.line_no + w.w - 1 <= l.n)"""

SQL_LOCATE_EXACT = f"""WITH {_WINDOWS_SQL},
many AS (SELECT doc_id, doc_id % 4 + 2 AS size, list_slice(arr, doc_id % (n - (doc_id % 4 + 2) + 1) + 1,
                doc_id % (n - (doc_id % 4 + 2) + 1) + doc_id % 4 + 2) AS ls FROM texts WHERE n >= doc_id % 4 + 2),
f AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS finding_id, snippet FROM pick
      UNION ALL SELECT doc_id, CAST(doc_id AS VARCHAR) || 'm', array_to_string(ls, ' ') FROM many),
h AS (SELECT f.finding_id, min({{'w': win.w, 's': win.s}}) AS x FROM f JOIN win ON win.doc_id = f.doc_id
        AND win.t = trim(regexp_replace(f.snippet, '\\s+', ' ', 'g')) GROUP BY 1)
SELECT finding_id, CAST(x.s AS BIGINT) AS start, CAST(x.s + x.w - 1 AS BIGINT) AS "end", CAST(x.w AS BIGINT) AS n_lines FROM h"""


def _fuzzy_findings(lines: DataFrame) -> DataFrame:
    chars = F.length(locate.collapse_ws(F.col("line_text")))
    return lines.filter(chars > 0).withColumn(
        "snippet", F.concat("line_text", F.repeat(F.lit(NOT_PRESENT[0]), (F.floor(chars / 2) + 1).cast("int"))))


SQL_RUN_SCAN = f"""WITH {CORPUS_CTES}, {_FIXTURE_SUBSETS_SQL}, {_PLAN_SQL},
mem AS (SELECT p.repo_id, p.subset_id, p.pipeline_id, u.i - 1 AS i, p.fps[u.i] AS path
        FROM plan p JOIN cat ON cat.pipeline_id = p.pipeline_id, LATERAL (SELECT unnest(generate_series(1, len(p.fps))) AS i) u),
arrs AS (SELECT repo_id, path, CASE WHEN a[len(a)] = '' THEN a[1:len(a) - 1] ELSE a END AS arr
         FROM (SELECT repo_id, path, string_split(content, chr(10)) AS a FROM kept)),
w AS (SELECT a.repo_id, a.path, w.w, s.s, trim(regexp_replace(array_to_string(list_slice(a.arr, s.s, s.s + w.w - 1), ' '), '\\s+', ' ', 'g')) AS t
      FROM arrs a, (SELECT unnest(generate_series(1, 5)) AS w) w, LATERAL (SELECT unnest(generate_series(1, len(a.arr) - w.w + 1)) AS s) s),
ask AS (SELECT m.repo_id, m.path, m.i % 4 AS k, min({{'w': w.w, 's': w.s}}) AS x
        FROM (SELECT DISTINCT repo_id, path, i % 4 AS i FROM mem WHERE i % 4 IN (0, 3)) m JOIN arrs a ON a.repo_id = m.repo_id AND a.path = m.path
        JOIN w ON w.repo_id = m.repo_id AND w.path = m.path
         AND w.t = trim(regexp_replace(array_to_string(a.arr[1:CASE m.i WHEN 0 THEN 1 ELSE 2 END], ' '), '\\s+', ' ', 'g'))
        GROUP BY 1, 2, 3)
SELECT m.repo_id, m.subset_id, m.pipeline_id, m.i AS pos, m.path AS file_path,
       CASE WHEN m.i % 4 = 2 THEN 3 ELSE CAST(ask.x.s AS BIGINT) END AS start, CASE WHEN m.i % 4 = 2 THEN 2 ELSE CAST(ask.x.w AS BIGINT) END AS n_lines
FROM mem m LEFT JOIN ask ON ask.repo_id = m.repo_id AND ask.path = m.path AND ask.k = m.i % 4 WHERE m.i % 4 <> 1
UNION ALL
SELECT repo_id, NULL, NULL, count(*), '(removed)', NULL, NULL FROM mem WHERE i % 4 = 1 GROUP BY 1"""


def q_locate_fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    """L1 on inexact snippets (difflib path): a line of every document with k characters after it that
    occur nowhere, k = L // 2 + 1 for a line of L collapsed characters.  No window can match more than
    L characters of it, so the first line with the same text is the answer, with score 2L / (2L + k)."""
    f = written(_fuzzy_findings(_locate_findings(spark, sf)).select("finding_id", "repo_id", "path", "doc_id", "snippet"), "located-findings")
    loc = locate.locate_snippets(f.select("finding_id", "repo_id", "path", "snippet"), _with_text(_files(spark, sf)))
    return f.join(loc, "finding_id").select("doc_id", F.col("start").cast("bigint"), F.col("end").cast("bigint"), "score")


SQL_LOCATE_FUZZY = f"""WITH {_LINES_SQL},
c AS (SELECT p.doc_id, h.start, length(trim(regexp_replace(p.snippet, '\\s+', ' ', 'g'))) AS n
      FROM pick p JOIN hit h ON h.doc_id = p.doc_id)
SELECT doc_id, CAST(start AS BIGINT) AS start, CAST(start AS BIGINT) AS "end", 2.0::DOUBLE * n / (2 * n + n // 2 + 1) AS score
FROM c WHERE n > 0"""


def _stored_findings(spark, sf) -> DataFrame:
    f = _locate_findings(spark, sf).withColumnRenamed("first_equal", "start")
    k = F.col("doc_id") % 4
    return f.select(
        "repo_id", "finding_id", F.col("path").alias("file_path"),
        F.when(k == 2, F.lit(NOT_PRESENT)).when(k == 3, F.lit(None).cast("string")).otherwise(F.col("line_text"))
        .alias("code_snippet"),
        F.when(k == 0, F.array(F.col("start"))).when(k == 1, F.array(F.col("start") + 1))
        .otherwise(F.array(F.lit(1))).cast("array<int>").alias("line"),
    )


def q_relocate_diff(spark: SparkSession, sf: str) -> DataFrame:
    """L3 + A5: relocation summary per repo (changed / unchanged / not found)."""
    r = locate.relocate_diff(written(_stored_findings(spark, sf), "stored-findings"), _with_text(_files(spark, sf)))
    return r["summary"].select("repo_id", *[F.col(c).cast("bigint").alias(c) for c in
                                            ["total_vulnerabilities", "changed_count", "unchanged_count",
                                             "not_found_count"]])


SQL_RELOCATE_DIFF = f"""WITH {_LINES_SQL},
c AS (SELECT p.repo_id, p.doc_id % 4 AS k FROM pick p)
SELECT repo_id, CAST(count(*) AS BIGINT) AS total_vulnerabilities,
       CAST(count(*) FILTER (WHERE k IN (1, 2)) AS BIGINT) AS changed_count,
       CAST(count(*) FILTER (WHERE k = 0) AS BIGINT) AS unchanged_count,
       CAST(count(*) FILTER (WHERE k = 2) AS BIGINT) AS not_found_count
FROM c GROUP BY 1"""


def q_relocate_changed(spark: SparkSession, sf: str) -> DataFrame:
    """L3: the rows that a relocation reports, with old and new lines (moved, and no longer found)."""
    r = locate.relocate_diff(written(_stored_findings(spark, sf), "stored-findings"), _with_text(_files(spark, sf)))
    told = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return r["changed"].select("repo_id", "finding_id", told("old_line").alias("old_line"), told("new_line").alias("new_line"))


SQL_RELOCATE_CHANGED = f"""WITH {_LINES_SQL}
SELECT p.repo_id, CAST(p.doc_id AS VARCHAR) AS finding_id,
       CASE p.doc_id % 4 WHEN 1 THEN CAST(h.start + 1 AS VARCHAR) ELSE '1' END AS old_line,
       CASE p.doc_id % 4 WHEN 1 THEN CAST(h.start AS VARCHAR) ELSE '' END AS new_line
FROM pick p LEFT JOIN hit h ON h.doc_id = p.doc_id WHERE p.doc_id % 4 IN (1, 2)"""


def q_rule_screen(spark: SparkSession, sf: str) -> DataFrame:
    """Rule hits over page HTML and documents, per rule."""
    pages = read_table(spark, sf, "pages").select(
        F.lit("pages").alias("repo_id"), F.col("page_id").cast("string").alias("path"), F.col("html").alias("text"))
    docs = _files(spark, sf).select(F.lit("documents").alias("repo_id"), "path", F.col("content").alias("text"))
    hits = rules.screen_rules(pages.unionByName(docs))
    return hits.groupBy(F.col("repo_id").alias("source_table"), "rule_id").agg(
        F.count(F.lit(1)).alias("n_hits"), F.countDistinct("file_path").alias("n_files"))


def _rules_sql() -> str:
    sel = []
    for r in rules.DEFAULT_RULES:
        sel.append(f"SELECT src, {_q(r['rule_id'])} AS rule_id, path FROM l WHERE regexp_matches(line, {_q(r['pattern'])})")
    return "\nUNION ALL\n".join(sel)


SQL_RULE_SCREEN = f"""WITH t AS (
  SELECT 'pages' AS src, CAST(page_id AS VARCHAR) AS path, html AS text FROM pages
  UNION ALL SELECT 'documents', CAST(doc_id AS VARCHAR), text FROM documents),
l AS (SELECT src, path, unnest(string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10))) AS line FROM t),
h AS ({_rules_sql()})
SELECT src AS source_table, rule_id, CAST(count(*) AS BIGINT) AS n_hits, CAST(count(DISTINCT path) AS BIGINT) AS n_files
FROM h GROUP BY 1, 2"""


def q_call_stats(spark: SparkSession, sf: str) -> DataFrame:
    """M1 replay + M3 over conversations: each user turn is a request (all turns so far), the
    next assistant turn its stored answer."""
    conv = read_table(spark, sf, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    has_sys = F.max((F.col("role") == "system").cast("int")).over(Window.partitionBy("conv_id"))
    turns = conv.withColumn("msgs", F.collect_list(F.struct(F.col("role"), F.col("text").alias("content"))).over(w)) \
        .withColumn("op", F.when(has_sys == 1, F.lit("chat-with-system")).otherwise(F.lit("chat")))
    reqs = turns.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("op").alias("operation"), F.col("msgs").alias("messages"),
        model.params("gpt-4o", temperature=0.2).alias("params"))
    reqs = reqs.withColumn("request_id", model.request_id(F.col("operation"), F.col("messages"), F.col("params")))
    answers = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("content"))
    responses = reqs.join(answers, ["conv_id", "turn"]).select("request_id", "content", F.lit("ok").alias("status"))
    failed = responses.select("request_id", F.lit(None).cast("string").alias("content"), F.lit("error").alias("status"))
    return model.call_stats(model.replay(reqs, responses.unionByName(failed)))


SQL_CALL_STATS = """WITH c AS (
  SELECT *, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pc,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nrole, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS ntext,
         lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nturn,
         max(CASE WHEN role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS hs
  FROM conversations),
r AS (SELECT CASE WHEN hs = 1 THEN 'chat-with-system' ELSE 'chat' END AS operation, pc,
             CASE WHEN nrole = 'assistant' AND nturn = turn + 1 THEN ntext END AS answer
      FROM c WHERE role = 'user')
SELECT operation, CAST(count(*) AS BIGINT) AS n_requests, CAST(sum(pc) AS BIGINT) AS prompt_chars,
       CAST(sum(coalesce(length(answer), 0)) AS BIGINT) AS answer_chars,
       CAST(count(*) FILTER (WHERE answer IS NULL) AS BIGINT) AS n_missing
FROM r GROUP BY 1"""


#: What follows a JSON value in a bad answer; each must make the whole answer invalid.
JSON_GARBAGE = [" xx", "]", "] trailing", "}] foo", ',"b":1}', "}"]


def q_json_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """T4-T7 + T11 over events: strict parse of props-based answers, shape tests, params JSON."""
    ev = read_table(spark, sf, "events")
    garbage = F.element_at(F.array(*[F.lit(x) for x in JSON_GARBAGE]), (F.col("event_id") % len(JSON_GARBAGE) + 1).cast("int"))
    ans = (F.when(F.col("event_type") == "error", F.concat("props", garbage))
           .when(F.col("event_type") == "click", F.concat(F.lit("["), F.col("props"), F.lit("]")))
           .otherwise(F.col("props")))
    v = jsonx.parse_json_strict(ans)
    prm = F.struct(F.col("event_type").alias("model"),
                   F.when(F.col("event_type") != "view", F.col("value")).alias("temperature"),
                   F.col("user_id").alias("max_tokens"))
    return ev.select(
        "event_id", jsonx.is_object(v).alias("is_object"), jsonx.is_array(v).alias("is_array"),
        F.try_variant_get(v, "$.k", "bigint").alias("k"), jsonx.params_json(prm).alias("params_json"),
    )


SQL_JSON_SHAPES = """SELECT event_id,
  event_type NOT IN ('error', 'click') AS is_object, event_type = 'click' AS is_array,
  CASE WHEN event_type NOT IN ('error', 'click') THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
  '{"model":"' || event_type || '"'
    || CASE WHEN event_type <> 'view' THEN ',"temperature":' || CAST(value AS VARCHAR) ELSE '' END
    || ',"max_tokens":' || CAST(user_id AS VARCHAR) || '}' AS params_json
FROM events"""


def q_import_extract(spark: SparkSession, sf: str) -> DataFrame:
    """F9 over documents whose lines are made import statements (first line 'import', others 'from')."""
    docs = read_table(spark, sf, "documents")
    t = F.concat(F.lit("import "), F.replace(F.col("text"), F.lit("\n"), F.lit("\nfrom ")))
    imp = extract_imports(t)
    return docs.select("doc_id", F.size(imp).cast("bigint").alias("n_imports"), F.array_join(imp, "|").alias("imports"))


SQL_IMPORT_EXTRACT = """WITH t AS (SELECT doc_id, 'import ' || replace(text, chr(10), chr(10) || 'from ') AS s FROM documents),
l AS (SELECT doc_id, u.i, u.line FROM t, LATERAL (SELECT unnest(string_split(s, chr(10))) AS line,
                                                  unnest(generate_series(1, len(string_split(s, chr(10))))) AS i) u),
m AS (SELECT doc_id, i, regexp_extract(trim(line), '^(?:import|from)\\s+([\\pL\\p{Nd}\\pM_./\\-@]+)', 1) AS mod
      FROM l)
SELECT doc_id, CAST(count(*) FILTER (WHERE mod <> '') AS BIGINT) AS n_imports,
       coalesce(string_agg(mod, '|' ORDER BY i) FILTER (WHERE mod <> ''), '') AS imports
FROM m GROUP BY 1"""


def q_stream_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Every document dropped twice (an older version, then the real one, and a third of them once
    more unchanged) in three drops that a Structured Streaming query reads one after the other."""
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    drops = os.path.join(base, "drops")
    files = _files(spark, sf)
    src = files.select("repo_id", "path", "content", "doc_id")
    old = F.concat("content", F.lit(" (old)"))
    again = src.filter(F.col("doc_id") % 3 == 0)
    versions = [src.select("repo_id", "path", old.alias("content"), F.lit(1).cast("long").alias("seq")),
                src.select("repo_id", "path", "content", F.lit(2).cast("long").alias("seq")),
                again.select("repo_id", "path", old.alias("content"), F.lit(3).cast("long").alias("seq")).unionByName(
                    again.select("repo_id", "path", "content", F.lit(4).cast("long").alias("seq")))]
    for i, drop in enumerate(versions):
        drop.write.mode("overwrite").parquet(os.path.join(drops, f"drop_{i}"))
        q = incremental_metadata(spark, drops + "/*", os.path.join(base, "state"), os.path.join(base, "ckpt"))
        q.awaitTermination()
    cur = current_metadata(spark, os.path.join(base, "state"))
    return cur.select("repo_id", "path", "sha1", "loc", "token_estimate", "language", "change")


SQL_STREAM_METADATA = f"""WITH {FILES_SQL}
SELECT repo_id, path, sha1(content) AS sha1, {loc_sql('content')} AS loc, {tok_sql('content')} AS token_estimate,
       {lang_sql('path')} AS language, 'changed' AS change
FROM files"""


def q_grouping_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Subsets over the listed files, those with an id of 3 modulo 4 forgotten, checked against the metadata of kept files, so
    kept files are missing, others are unknown, and some subsets are too small."""
    large = _large(spark, sf)
    subsets = _bucketed_subsets(scan_corpus(large).filter(F.col("doc_id") % 4 != 3))
    a = grouping.audit_grouping(subsets, _fixture_metadata(_keep(large)))
    return a.groupBy("repo_id", "issue").agg(F.count(F.lit(1)).alias("n"))


SQL_GROUPING_AUDIT = f"""WITH {LARGE_CTES},
l AS (SELECT repo_id, path, {lang_sql('path')} AS language FROM scanned WHERE doc_id % 4 <> 3),
g AS (SELECT repo_id, language, bucket, count(*) AS n
      FROM (SELECT *, (row_number() OVER (PARTITION BY repo_id, language ORDER BY path) - 1) // {SUBSET_SIZE} AS bucket
            FROM l) GROUP BY 1, 2, 3),
issues AS (
  SELECT s.repo_id, 'unknown_path' AS issue FROM l s LEFT JOIN kept k ON k.repo_id = s.repo_id AND k.path = s.path
  WHERE k.path IS NULL
  UNION ALL SELECT repo_id, 'file_in_no_subset' FROM kept WHERE doc_id % 4 = 3
  UNION ALL SELECT repo_id, 'subset_size' FROM g WHERE n < 5 OR n > 15)
SELECT repo_id, issue, CAST(count(*) AS BIGINT) AS n FROM issues GROUP BY 1, 2"""


def q_stage_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A4: per repo, files listed, kept by the listing (S1), kept by the pre-filter (F1) and
    offered to the original's selection prompt (W3 head-30)."""
    files = _large(spark, sf)
    scanned = scan_corpus(files)
    kept = _keep(files)
    offered = head_n(kept.select("repo_id", "path"), P.SELECT_LIMIT, ["repo_id"], ["path"], remainder=False)
    return metrics.stage_metrics({"listed": files, "scanned": scanned, "kept": kept, "offered": offered})


SQL_STAGE_METRICS = f"""WITH {LARGE_CTES},
o AS (SELECT repo_id FROM (SELECT repo_id, row_number() OVER (PARTITION BY repo_id ORDER BY path) AS rn FROM kept)
      WHERE rn <= {P.SELECT_LIMIT})
SELECT repo_id, 'listed' AS stage, count(*) AS n FROM files GROUP BY 1
UNION ALL SELECT repo_id, 'scanned', count(*) FROM scanned GROUP BY 1
UNION ALL SELECT repo_id, 'kept', count(*) FROM kept GROUP BY 1
UNION ALL SELECT repo_id, 'offered', count(*) FROM o GROUP BY 1"""


def q_selection_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The model picks two offered paths plus a path it was never shown; the audit reports
    the unknown one per repo."""
    kept = _kept(spark, sf)
    offered = head_n(kept.select("repo_id", "path"), P.SELECT_LIMIT, ["repo_id"], ["path"], remainder=False)
    w = Window.partitionBy("repo_id").orderBy("path")
    two = offered.withColumn("rn", F.row_number().over(w)).filter("rn <= 2").groupBy("repo_id").agg(
        F.sort_array(F.collect_list("path")).alias("ps"))
    picks = F.concat(F.col("ps"), F.array(F.concat(F.lit("src/secret/"), F.col("repo_id"), F.lit(".env"))))
    answers = two.select("repo_id", F.to_json(picks).alias("content"))
    sel = selection.selection_result(kept, answers)
    return selection.audit_selection(sel, offered).select("repo_id", "pos", "path", "origin")


SQL_SELECTION_AUDIT = f"""WITH {CORPUS_CTES},
r AS (SELECT repo_id, count(*) AS n FROM kept GROUP BY 1)
SELECT repo_id, CAST(least(n, 2) + 1 AS BIGINT) AS pos, 'src/secret/' || repo_id || '.env' AS path, 'model' AS origin
FROM r"""


def q_summary_requests(spark: SparkSession, sf: str) -> DataFrame:
    """G5 requests for every kept file: instructions around its whole text."""
    p = metadata.profile(_kept(spark, sf)).drop("content")
    r = metadata.summary_requests(p)
    return r.select("repo_id", "path", "operation", F.length(F.col("messages")[1]["content"]).cast("bigint")
                    .alias("prompt_chars"), F.sha1(F.col("messages")[1]["content"]).alias("prompt_sha1"),
                    F.col("params_json"))


SQL_SUMMARY_REQUESTS = f"""WITH {CORPUS_CTES},
p AS (SELECT repo_id, path, {_q(P.SUMMARY_PROMPT_HEAD)} || content
             || {_q(P.SUMMARY_PROMPT_TAIL)} AS u FROM kept)
SELECT repo_id, path, {_q(P.OP_SUMMARY)} AS operation, CAST(length(u) AS BIGINT) AS prompt_chars, sha1(u) AS prompt_sha1,
       '{{"model":"gpt-4o-mini","temperature":0.2,"max_tokens":200}}' AS params_json
FROM p"""


def q_tree_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """S3: every file as a nested tree document per directory, flattened back with S3's exclusions."""
    files = _files(spark, sf)
    dirs = files.select("repo_id", F.split("path", "/")[1].alias("dir"), F.split("path", "/")[2].alias("name"))
    inner = F.create_map(F.lit("__files__"), F.sort_array(F.collect_list("name")))
    trees = dirs.groupBy("repo_id", "dir").agg(inner.alias("node")).select(
        "repo_id", F.to_json(F.create_map(F.lit("src"), F.create_map("dir", "node"))).alias("tree_json"))
    return flatten_tree(trees)


SQL_TREE_FLATTEN = f"""WITH {FILES_SQL}
SELECT repo_id, path FROM files WHERE NOT list_contains({_sql_list(FLATTEN_EXCLUDE_DIRS)}, split_part(path, '/', 2))"""


def q_selection_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Selection documents per repo in the current and the legacy form, read back."""
    files = _files(spark, sf).filter(F.length("content") > 0)
    paths = files.groupBy("repo_id").agg(F.sort_array(F.collect_list("path")).alias("ps"))
    current = F.to_json(F.struct(F.col("ps").alias("files_to_analyze"), F.array(F.lit("ignored")).alias("standalone_files")))
    legacy = F.to_json(F.struct(F.array(F.lit("src/models")).alias("folders_to_analyze"), F.col("ps").alias("standalone_files")))
    docs = paths.select("repo_id", F.when(_repo_no() % 2 == 0, current).otherwise(legacy).alias("json"))
    return selection.read_selection(docs)


SQL_SELECTION_DOCUMENTS = f"""WITH {FILES_SQL},
r AS (SELECT repo_id, path, row_number() OVER (PARTITION BY repo_id ORDER BY path) AS n,
             CAST(regexp_extract(repo_id, '(\\d+)$', 1) AS INTEGER) % 2 AS k FROM files WHERE length(content) > 0)
SELECT repo_id, CAST(n + k AS BIGINT) AS pos, path FROM r
UNION ALL SELECT DISTINCT repo_id, CAST(1 AS BIGINT), 'src/models' FROM r WHERE k = 1"""


def q_decode_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """every text as bytes, half of them with bytes that are no UTF-8 at both ends."""
    bad = F.unhex(F.lit("C328FF"))  # a broken sequence around "(", and a byte that never occurs
    raw = F.col("content").cast("binary")
    files = _files(spark, sf).withColumn("raw", F.when(F.col("doc_id") % 2 == 0, F.concat(bad, raw, bad)).otherwise(raw))
    return files.select("doc_id", F.sha1(decode_ignore("raw")).alias("text_sha1"))


SQL_DECODE_BYTES = f"""WITH {FILES_SQL}
SELECT doc_id, sha1(CASE WHEN doc_id % 2 = 0 THEN '(' || content || '(' ELSE content END) AS text_sha1 FROM files"""


def q_call_params(spark: SparkSession, sf: str) -> DataFrame:
    """M2: the parameters of both kinds of models, one request per event."""
    ev = read_table(spark, sf, "events")
    name = F.element_at(F.array(*[F.lit(x) for x in PARAM_MODELS]), (F.col("event_id") % len(PARAM_MODELS) + 1).cast("int"))
    prm = model.params(name, temperature=0.2, max_tokens=200, reasoning_effort="low")
    return ev.select("event_id", F.to_json(prm).alias("params_json"))


PARAM_MODELS = [P.DEFAULT_MODEL, *P.COMPLETION_TOKEN_MODELS]

SQL_CALL_PARAMS = f"""WITH e AS (SELECT event_id, ({_sql_list(PARAM_MODELS)})[event_id % {len(PARAM_MODELS)} + 1] AS m FROM events)
SELECT event_id, CASE WHEN m IN ('gpt-5', 'gpt-5-mini')
  THEN '{{"model":"' || m || '","max_completion_tokens":200,"reasoning_effort":"low","stream":false}}'
  ELSE '{{"model":"' || m || '","temperature":0.2,"max_tokens":200}}' END AS params_json FROM e"""


def q_findings_document(spark: SparkSession, sf: str) -> DataFrame:
    """S9 + W7: one finding per document and pipeline as a document per repo, read back in its order."""
    f = _files(spark, sf).select(
        "repo_id", (F.col("doc_id") % 7).cast("int").alias("suggestion_no"), F.lit(0).alias("pipeline_pos"),
        F.col("doc_id").alias("pos"), F.col("path").alias("file_path"), F.lit(None).cast("string").alias("code_snippet"),
        F.sha1("content").alias("description"), F.lit("v").alias("vulnerability"), F.lit("High").alias("severity"),
        F.lit("Low").alias("confidence_level"), F.lit("r").alias("remediation"), F.array(F.lit(1), F.lit(2)).alias("line"))
    back = artifacts.findings_from_json(artifacts.findings_documents(f))
    return back.select("repo_id", "pos", "file_path", "description", F.size("line").cast("bigint").alias("n_lines"))


SQL_FINDINGS_DOCUMENT = f"""WITH {FILES_SQL}
SELECT repo_id, CAST(row_number() OVER (PARTITION BY repo_id ORDER BY doc_id % 7, doc_id) - 1 AS BIGINT) AS pos, path AS file_path,
       sha1(content) AS description, CAST(2 AS BIGINT) AS n_lines FROM files"""


def q_findings_export(spark: SparkSession, sf: str) -> DataFrame:
    """S9 + W7 + S6: the findings of ``findings_document`` exported as one file per repo and read back with its type."""
    f = _files(spark, sf).select(
        "repo_id", (F.col("doc_id") % 7).cast("int").alias("suggestion_no"), F.lit(0).alias("pipeline_pos"),
        F.col("doc_id").alias("pos"), F.col("path").alias("file_path"), F.substring("content", 1, 200).alias("code_snippet"),
        F.sha1("content").alias("description"), F.lit("v").alias("vulnerability"), F.lit("High").alias("severity"),
        F.lit("Low").alias("confidence_level"), F.lit("r").alias("remediation"), F.array(F.lit(1), F.lit(2)).alias("line"))
    out = scratch_path(spark, f"findings-{uuid.uuid4().hex}")
    documents.export_findings(f, out)
    rows, errors = documents.read_artifact(spark, "findings", out)
    back = rows.select("repo_id", "pos", "file_path", F.sha1("code_snippet").alias("snippet_sha1"), F.size("line").cast("bigint").alias("n_lines"))
    return back.unionByName(errors.select("repo_id", F.lit(None).cast("bigint").alias("pos"), F.col("file_name").alias("file_path"),
                                          F.col("error").alias("snippet_sha1"), F.lit(None).cast("bigint").alias("n_lines")))


SQL_FINDINGS_EXPORT = f"""WITH {FILES_SQL}
SELECT repo_id, CAST(row_number() OVER (PARTITION BY repo_id ORDER BY doc_id % 7, doc_id) - 1 AS BIGINT) AS pos, path AS file_path,
       sha1(substr(content, 1, 200)) AS snippet_sha1, CAST(2 AS BIGINT) AS n_lines FROM files"""


def q_artifact_read(spark: SparkSession, sf: str) -> DataFrame:
    """A subsets document per repo and thousand ids with one subset for each of its files, written as files, beside one cut in the middle and one
    with a wrong third entry per document: the typed rows and the error rows."""
    f = _files(spark, sf).withColumn("repo_id", F.concat("repo_id", F.lit("-"), F.floor(F.col("doc_id") / 1000).cast("string")))
    entry = F.struct(F.col("doc_id").cast("string").alias("subset_id"), F.array("path").alias("file_paths"), F.sha1("content").alias("reason"))
    docs = f.groupBy("repo_id").agg(F.sort_array(F.collect_list(F.struct("doc_id", entry.alias("e")))).alias("xs"))
    docs = docs.select("repo_id", F.to_json(F.col("xs.e")).alias("text"), F.col("xs.e").alias("es"))
    cut = docs.select(F.concat("repo_id", F.lit("/cut.json")).alias("name"), F.expr("substring(text, 1, length(text) - 1)").alias("text"))
    wrong = docs.select(F.concat("repo_id", F.lit("/wrong.json")).alias("name"), F.concat(
        F.lit("["), F.array_join(F.transform(F.slice("es", 1, 2), lambda e: F.to_json(e)), ","), F.lit(',{"subset_id":7}]')).alias("text"))
    out = scratch_path(spark, f"subsets-{uuid.uuid4().hex}")
    documents.write_files(docs.select(F.concat("repo_id", F.lit(".json")).alias("name"), "text").unionByName(cut).unionByName(wrong), out)
    rows, errors = documents.read_artifact(spark, "subsets", out)
    good = rows.select("repo_id", F.col("subset_no").cast("bigint").alias("subset_no"), F.col("file_paths")[0].alias("path"), "reason")
    return good.unionByName(errors.select("repo_id", F.lit(None).cast("bigint").alias("subset_no"), F.lit(None).cast("string").alias("path"),
                                          F.col("error").alias("reason")))


SQL_ARTIFACT_READ = f"""WITH {FILES_SQL.replace("source AS repo_id", "source || '-' || CAST(doc_id // 1000 AS VARCHAR) AS repo_id")},
repos AS (SELECT repo_id, count(*) AS n FROM files GROUP BY 1)
SELECT repo_id, CAST(row_number() OVER (PARTITION BY repo_id ORDER BY doc_id) AS BIGINT) AS subset_no, path, sha1(content) AS reason FROM files
UNION ALL SELECT repo_id || '/cut', NULL, NULL, 'not_json' FROM repos
UNION ALL SELECT repo_id || '/wrong', NULL, NULL, 'bad_entry:' || CAST(least(n, 2) AS VARCHAR) FROM repos"""


def q_stage_output_files(spark: SparkSession, sf: str) -> DataFrame:
    """S7 + S8: stage outputs written in two runs, the second replacing every other one, and read back."""
    path = scratch_path(spark, f"stage-outputs-{uuid.uuid4().hex}")
    f = _files(spark, sf)
    out = f.select("repo_id", F.col("path").alias("subset_id"), F.lit("pipeline_xss").alias("pipeline_id"),
                   F.lit("findings").alias("output_tag"), F.lit(True).alias("save_output"), F.sha1("content").alias("payload"), "doc_id")
    artifacts.write_stage_outputs(out.drop("doc_id"), path)
    again = out.filter(F.col("doc_id") % 2 == 0).withColumn("payload", F.concat("payload", F.lit(" again"))).drop("doc_id")
    artifacts.write_stage_outputs(again, path)
    return spark.read.parquet(path).select("repo_id", "subset_id", "payload")


SQL_STAGE_OUTPUT_FILES = f"""WITH {FILES_SQL}
SELECT repo_id, path AS subset_id, sha1(content) || CASE WHEN doc_id % 2 = 0 THEN ' again' ELSE '' END AS payload FROM files"""


QUERIES = {
    "relocate_changed": q_relocate_changed,
    "tree_flatten": q_tree_flatten,
    "selection_documents": q_selection_documents,
    "decode_bytes": q_decode_bytes,
    "call_params": q_call_params,
    "findings_document": q_findings_document,
    "findings_export": q_findings_export,
    "artifact_read": q_artifact_read,
    "stage_output_files": q_stage_output_files,
    "language_profile": q_language_profile,
    "file_profile": q_file_profile,
    "url_paths": q_url_paths,
    "tree_edges": q_tree_edges,
    "selection_requests": q_selection_requests,
    "selection_result": q_selection_result,
    "selection_batch_requests": q_selection_batch_requests,
    "selection_batch_result": q_selection_batch_result,
    "metadata_changes": q_metadata_changes,
    "metadata_upsert": q_metadata_upsert,
    "grouping_requests": q_grouping_requests,
    "grouping_parse": q_grouping_parse,
    "grouping_audit": q_grouping_audit,
    "suggestion_requests": q_suggestion_requests,
    "suggestion_requests_whole": q_suggestion_requests_whole,
    "suggestion_parse": q_suggestion_parse,
    "run_plan": q_run_plan,
    "context_bundle": q_context_bundle,
    "context_bundle_cut": q_context_bundle_cut,
    "scan_requests": q_scan_requests,
    "findings_parse": q_findings_parse,
    "run_scan": q_run_scan,
    "stage_graph": q_stage_graph,
    "locate_exact": q_locate_exact,
    "locate_fuzzy": q_locate_fuzzy,
    "relocate_diff": q_relocate_diff,
    "rule_screen": q_rule_screen,
    "call_stats": q_call_stats,
    "json_shapes": q_json_shapes,
    "import_extract": q_import_extract,
    "stream_metadata": q_stream_metadata,
    "stage_metrics": q_stage_metrics,
    "selection_audit": q_selection_audit,
    "summary_requests": q_summary_requests,
}

ORACLE_SQL = {
    "relocate_changed": SQL_RELOCATE_CHANGED,
    "run_scan": SQL_RUN_SCAN,
    "stage_graph": SQL_STAGE_GRAPH,
    "tree_flatten": SQL_TREE_FLATTEN,
    "selection_documents": SQL_SELECTION_DOCUMENTS,
    "decode_bytes": SQL_DECODE_BYTES,
    "call_params": SQL_CALL_PARAMS,
    "findings_document": SQL_FINDINGS_DOCUMENT,
    "findings_export": SQL_FINDINGS_EXPORT,
    "artifact_read": SQL_ARTIFACT_READ,
    "stage_output_files": SQL_STAGE_OUTPUT_FILES,
    "language_profile": SQL_LANGUAGE_PROFILE,
    "file_profile": SQL_FILE_PROFILE,
    "url_paths": SQL_URL_PATHS,
    "tree_edges": SQL_TREE_EDGES,
    "selection_requests": SQL_SELECTION_REQUESTS,
    "selection_result": SQL_SELECTION_RESULT,
    "selection_batch_requests": SQL_SELECTION_BATCH_REQUESTS,
    "selection_batch_result": SQL_SELECTION_BATCH_RESULT,
    "metadata_changes": SQL_METADATA_CHANGES,
    "metadata_upsert": SQL_METADATA_UPSERT,
    "grouping_requests": SQL_GROUPING_REQUESTS,
    "grouping_parse": SQL_GROUPING_PARSE,
    "grouping_audit": SQL_GROUPING_AUDIT,
    "suggestion_requests": SQL_SUGGESTION_REQUESTS,
    "suggestion_requests_whole": SQL_SUGGESTION_REQUESTS_WHOLE,
    "suggestion_parse": SQL_SUGGESTION_PARSE,
    "run_plan": SQL_RUN_PLAN,
    "context_bundle": SQL_CONTEXT_BUNDLE,
    "context_bundle_cut": SQL_CONTEXT_BUNDLE_CUT,
    "scan_requests": SQL_SCAN_REQUESTS,
    "findings_parse": SQL_FINDINGS_PARSE,
    "locate_exact": SQL_LOCATE_EXACT,
    "locate_fuzzy": SQL_LOCATE_FUZZY,
    "relocate_diff": SQL_RELOCATE_DIFF,
    "rule_screen": SQL_RULE_SCREEN,
    "call_stats": SQL_CALL_STATS,
    "json_shapes": SQL_JSON_SHAPES,
    "import_extract": SQL_IMPORT_EXTRACT,
    "stream_metadata": SQL_STREAM_METADATA,
    "stage_metrics": SQL_STAGE_METRICS,
    "selection_audit": SQL_SELECTION_AUDIT,
    "summary_requests": SQL_SUMMARY_REQUESTS,
}
