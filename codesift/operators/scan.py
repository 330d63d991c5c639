"""Running pipelines on subsets: J6 plan_runs, A2/W4 bundle_context, E1 scan_requests,
E2 parse_findings, K1 check_findings, F12 drop_unlocated, L2 run_scan, W7 order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesift.functions import jsonx
from codesift.functions.paths import relativize
from codesift.functions.text import py_strip
from codesift.operators.locate import locate_snippets
from codesift.operators.metrics import observed
from codesift.plans import model
from codesift.plans import prompts as P
from codesift.session import materialize, written

FINDING_FIELDS = ["file_path", "code_snippet", "description", "vulnerability", "severity",
                  "confidence_level", "remediation"]


def plan_runs(suggestions: DataFrame, subsets: DataFrame, catalog: DataFrame, strict: bool = False) -> DataFrame:
    """One row per (subset, suggested pipeline) in suggestion order, with the subset's
    files and the pipeline's first stage.

    Unknown subset or pipeline ids raise with ``strict=True`` (as the original tool does);
    otherwise they are kept with ``plan_status`` 'unknown_subset' / 'unknown_pipeline'.
    Duplicate subset ids: the last one wins.
    """
    s = suggestions.select("repo_id", "subset_id", F.col("subset_no").alias("suggestion_no"),
                           F.posexplode("suggested_pipelines").alias("pipeline_pos", "pipeline_id"))
    last = Window.partitionBy("repo_id", "subset_id").orderBy(F.col("subset_no").desc())
    subs = (
        subsets.withColumn("_r", F.row_number().over(last)).filter(F.col("_r") == 1)
        .select("repo_id", "subset_id", "file_paths", F.lit(True).alias("_has_subset"))
    )
    cat = catalog.select("pipeline_id", F.col("stages")[0].alias("stage"), F.lit(True).alias("_has_pipeline"))
    plan = s.join(subs, ["repo_id", "subset_id"], "left").join(cat, "pipeline_id", "left")
    status = (
        F.when(F.col("_has_subset").isNull(), F.lit("unknown_subset"))
        .when(F.col("_has_pipeline").isNull(), F.lit("unknown_pipeline"))
        .otherwise(F.lit("ok"))
    )
    plan = plan.withColumn("plan_status", status)
    if strict:
        plan = plan.withColumn("plan_status", F.when(F.col("plan_status") == "ok", F.col("plan_status")).otherwise(
            F.raise_error(F.concat(F.col("plan_status"), F.lit(": "), F.col("subset_id"), F.lit("/"),
                                   F.col("pipeline_id")))))
    return plan.drop("_has_subset", "_has_pipeline")


#: The fixed characters of a part, around its path (twice) and its text.
PART_MARKS = "\n=====\nFILE: " + "\n=====\n" + "\n=====\nEND OF FILE: " + "\n=====\n"

#: A larger bundle is reported, not assembled: one string is built in one task.
MAX_BUNDLE_BYTES = 512 << 20


def bundle_parts(subsets: DataFrame, files: DataFrame, root: str | None = None) -> DataFrame:
    """One part per listed, readable file of each subset:
    '\\n=====\\nFILE: p\\n=====\\n' + text + '\\n=====\\nEND OF FILE: p\\n=====\\n'.
    ``p`` is ``root/path`` when ``root`` is given (the original shows absolute paths)."""
    return _parts(subsets.select("repo_id", "subset_id", F.posexplode("file_paths").alias("fpos", "path")), files, root)


def _parts(members: DataFrame, files: DataFrame, root: str | None) -> DataFrame:
    """``_take``, if there, is how many characters of a part are wanted."""
    joined = members.join(files.select("repo_id", "path", "text"), ["repo_id", "path"], "inner")
    shown = F.concat(F.lit(root.rstrip("/") + "/"), F.col("path")) if root else F.col("path")
    part = F.concat(F.lit("\n=====\nFILE: "), shown, F.lit("\n=====\n"), F.col("text"),
                    F.lit("\n=====\nEND OF FILE: "), shown, F.lit("\n=====\n"))
    if "_take" in members.columns:
        part = F.substring(part, F.lit(1), F.col("_take").cast("int"))
    return joined.select("repo_id", "subset_id", "fpos", "path", part.alias("part"))


def _members(subsets: DataFrame, files: DataFrame, max_chars: int | None, root: str | None) -> DataFrame:
    """The parts of each subset as sizes and SHA-1 of their texts, one row per file that reaches the bundle; no text travels."""
    sized = files.select("repo_id", "path", F.length("text").cast("bigint").alias("_chars"), F.octet_length("text").cast("bigint").alias("_bytes"),
                         F.sha1("text").alias("_sha1"))
    members = subsets.select("repo_id", "subset_id", F.posexplode("file_paths").alias("fpos", "path")).join(sized, ["repo_id", "path"])
    shown = F.concat(F.lit(root.rstrip("/") + "/"), F.col("path")) if root else F.col("path")
    members = members.withColumn("_shown", shown)
    members = members.withColumn("_part", F.col("_chars") + 2 * F.length("_shown") + len(PART_MARKS)) \
        .withColumn("_part_bytes", F.col("_bytes") + 2 * F.octet_length("_shown") + len(PART_MARKS))
    if max_chars is None:
        return members
    w = Window.partitionBy("repo_id", "subset_id").orderBy("fpos").rowsBetween(Window.unboundedPreceding, -1)
    # start offset of a part = sum of earlier part lengths + one '\n' per earlier part; a part
    # starting exactly at the limit is kept for the separator in front of it
    start = F.coalesce(F.sum(F.col("_part") + 1).over(w), F.lit(0))
    members = members.withColumn("_take", F.lit(max_chars) - start).filter(F.col("_take") >= 0)
    # a character has at most four bytes
    return members.withColumn("_part_bytes", F.least("_part_bytes", 4 * F.col("_take")))


def bundle_index(subsets: DataFrame, files: DataFrame, max_chars: int | None = None, root: str | None = None) -> DataFrame:
    """What each subset's bundle is, without its text: ``n_parts``, ``bundle_bytes`` (with a cut: at most so many) and ``bundle_digest``.

    The digest is a hash over the ordered parts' paths and text hashes (and the cut), so equal bundles have equal digests
    and every text is hashed once, however many pipelines read it.
    """
    members = _members(subsets, files, max_chars, root)
    part = F.concat_ws("\u0001", "_shown", "_sha1")
    out = members.withColumn("_leaf", F.sha1(part)).groupBy("repo_id", "subset_id").agg(
        F.expr("listagg(_leaf, ',') WITHIN GROUP (ORDER BY fpos)").alias("_leaves"),
        F.count(F.lit(1)).alias("n_parts"), (F.sum(F.col("_part_bytes") + 1) - 1).alias("bundle_bytes"))
    keys = subsets.select("repo_id", "subset_id").distinct()
    digest = F.sha1(F.concat_ws("|", F.coalesce("_leaves", F.lit("")), F.lit("" if max_chars is None else str(max_chars))))
    return keys.join(out, ["repo_id", "subset_id"], "left").select(
        "repo_id", "subset_id", F.coalesce("n_parts", F.lit(0)).cast("bigint").alias("n_parts"),
        F.coalesce("bundle_bytes", F.lit(0)).cast("bigint").alias("bundle_bytes"), digest.alias("bundle_digest"))


def bundle_context(subsets: DataFrame, files: DataFrame, max_chars: int | None = None,
                   root: str | None = None, max_bytes: int = MAX_BUNDLE_BYTES) -> DataFrame:
    """A2 + W4: parts joined by '\\n' in list order, cut to ``max_chars`` characters (None: no cut).

    With a cut, the files whose parts start at or beyond the limit are dropped by a running
    sum of lengths before any text is joined, so a subset of huge files never shuffles or
    assembles more than it sends.  A bundle of more than ``max_bytes`` is not built in one task: its
    ``bundle`` is null and its ``bundle_status`` 'too_large' ('ok' else).  Also returns the columns of ``bundle_index``.
    """
    return _assemble(subsets, files, written(bundle_index(subsets, files, max_chars, root), "bundle-index"), max_chars, root, max_bytes)


def _assemble(subsets: DataFrame, files: DataFrame, index: DataFrame, max_chars: int | None, root: str | None, max_bytes: int) -> DataFrame:
    fits = F.col("bundle_bytes") <= max_bytes
    wanted = subsets.join(index.filter(fits).select("repo_id", "subset_id"), ["repo_id", "subset_id"], "left_semi")
    if max_chars is None:
        parts = bundle_parts(wanted, files, root)
    else:
        parts = _parts(_members(wanted, files, max_chars, root).select("repo_id", "subset_id", "fpos", "path", "_take"), files, root)
    text = parts.groupBy("repo_id", "subset_id").agg(F.expr("listagg(part, '\\n') WITHIN GROUP (ORDER BY fpos)").alias("bundle"))
    if max_chars is not None:
        text = text.withColumn("bundle", F.substring("bundle", 1, max_chars))
    return index.join(text, ["repo_id", "subset_id"], "left").select(
        "repo_id", "subset_id", F.when(fits, F.coalesce("bundle", F.lit(""))).alias("bundle"), "n_parts", "bundle_bytes", "bundle_digest",
        F.when(fits, F.lit("ok")).otherwise(F.lit("too_large")).alias("bundle_status"))


def request_rows(plan: DataFrame, index: DataFrame, model_name: str = P.DEFAULT_MODEL, extra: Column | None = None) -> DataFrame:
    """E1 without the bundles' texts: a row per (subset, pipeline) with ``operation``, ``params`` and ``request_id``.

    The id hashes everything that determines the answer, with the bundle as its ``bundle_digest`` (from ``bundle_index``).
    """
    ok = plan.filter(F.col("plan_status") == "ok").join(index.select("repo_id", "subset_id", "bundle_digest"), ["repo_id", "subset_id"])
    prm = model.params(model_name, max_tokens=P.SCAN_MAX_TOKENS, response_format=P.RESPONSE_FORMAT_JSON)
    rows = ok.withColumn("operation", F.concat(F.lit(P.OP_STAGE_PREFIX), F.col("stage.id"))).withColumn("params", prm) \
        .withColumn("params_json", F.to_json(F.col("params"))).withColumn("_extra", F.lit("") if extra is None else extra)
    return rows.withColumn("request_id", F.sha1(F.concat_ws(
        "\u0001", "operation", "params_json", F.sha1(_system()), F.lit(P.SCAN_USER_HEAD + P.SCAN_USER_TAIL), "bundle_digest", F.sha1("_extra"))))


def _system() -> Column:
    return F.concat(F.lit(P.SCAN_SYSTEM_HEAD), F.col("stage.prompt_template"), F.lit(P.SCAN_SCHEMA_TEXT),
                    F.lit(P.SCAN_EXAMPLE_HEAD), F.col("stage.example_json"))


def with_messages(rows: DataFrame, bundles: DataFrame) -> DataFrame:
    """``request_rows`` with their ``messages``: the bundles' texts join here, behind all decisions."""
    user = F.concat(F.lit(P.SCAN_USER_HEAD), F.col("bundle"), F.lit(P.SCAN_USER_TAIL), F.col("_extra"))
    texts = bundles.filter(F.col("bundle").isNotNull()).select("repo_id", "subset_id", "bundle")
    return rows.join(texts, ["repo_id", "subset_id"]).withColumn("messages", model.messages(_system(), user)).drop("_extra")


def scan_requests(plan: DataFrame, bundles: DataFrame, model_name: str = P.DEFAULT_MODEL, extra: Column | None = None) -> DataFrame:
    """Per (subset, pipeline): auditor preamble + stage prompt + finding schema + example,
    and the bundle in a code fence, with ``extra`` behind it if given; JSON-object answers, 720 output tokens.
    Bundles without text (too large) have no request."""
    return with_messages(request_rows(plan, bundles, model_name, extra), bundles)


def parse_findings(answered: DataFrame, content: str = "content") -> dict[str, DataFrame]:
    """``{"vulnerabilities": [...]}`` gives that list, a bare list itself, anything else none.

    Returns ``findings`` (one row per list element that is an object, ``pos`` = position),
    ``stage_outputs`` (S8 payload: the parsed answer, or ``{"raw_output": text}`` when it is
    not JSON) and ``answer_status`` per request.
    """
    v = F.col("_v")
    wrapped = jsonx.is_object(v) & jsonx.has_key(v, "vulnerabilities")
    inner = jsonx.get_field(v, "vulnerabilities")
    items = F.when(wrapped, jsonx.as_array(inner)).when(jsonx.is_array(v), jsonx.as_array(v))
    status = (
        F.when(F.col(content).isNull(), F.lit("missing"))
        .when(v.isNull(), F.lit("not_json"))
        .when(wrapped & ~jsonx.is_array(inner), F.lit("bad_vulnerabilities"))
        .when(items.isNull(), F.lit("no_findings_key"))
        .otherwise(F.lit("ok"))
    )
    a = jsonx.with_json(answered, py_strip(F.col(content)))
    a = jsonx.settled(a.withColumn("_items", items).withColumn("answer_status", status), "_items", "answer_status")
    payload = F.when(F.col("_v").isNotNull(), F.to_json(F.col("_v"))).otherwise(
        F.to_json(F.struct(F.col(content).alias("raw_output"))))
    keys = [c for c in ["repo_id", "subset_id", "suggestion_no", "pipeline_pos", "pipeline_id", "stage_no", "request_id"]
            if c in answered.columns]
    stage_outputs = a.filter(F.col(content).isNotNull()).select(
        *keys, F.col("stage.output_tag").alias("output_tag") if "stage" in answered.columns
        else F.lit(None).cast("string").alias("output_tag"),
        F.col("stage.save_output").alias("save_output") if "stage" in answered.columns
        else F.lit(True).alias("save_output"),
        payload.alias("payload"),
    )
    el = a.select(*keys, F.posexplode_outer("_items").alias("pos", "e")).filter(F.col("pos").isNotNull())
    el = el.filter(jsonx.is_object(F.col("e")))
    cols = [jsonx.get_string(F.col("e"), f).alias(f) for f in FINDING_FIELDS]
    # a model may give a line list itself; it counts where the snippet cannot be looked up
    findings = el.select(*keys, F.col("pos").cast("bigint").alias("pos"), *cols,
                         F.try_variant_get(F.col("e"), "$.line", "array<int>").alias("model_line"),
                         jsonx.has_key(F.col("e"), "code_snippet").alias("has_snippet"),
                         jsonx.has_key(F.col("e"), "file_path").alias("has_path"))
    return {"findings": findings, "stage_outputs": stage_outputs,
            "answer_status": a.select(*keys, "answer_status")}


def check_findings(findings: DataFrame) -> DataFrame:
    """K1: contract violations (required fields, enum values) as ``violations array<string>``;
    rows are reported, never dropped."""
    checks = [F.when(F.col(f).isNull(), F.lit(f"missing:{f}")) for f in P.FINDING_REQUIRED]
    checks.append(F.when(F.col("severity").isNotNull() & ~F.col("severity").isin(*P.SEVERITY_VALUES),
                         F.lit("bad_enum:severity")))
    checks.append(F.when(F.col("confidence_level").isNotNull() & ~F.col("confidence_level").isin(*P.CONFIDENCE_VALUES),
                         F.lit("bad_enum:confidence_level")))
    return findings.withColumn("violations", F.filter(F.array(*checks), lambda x: x.isNotNull()))


def drop_unlocated(findings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """keep findings with a non-empty ``line`` list; also returns removed counts per repo."""
    located = F.coalesce(F.size("line"), F.lit(-1)) > 0
    kept = findings.filter(located)
    removed = findings.filter(~located).groupBy("repo_id").agg(F.count(F.lit(1)).alias("n_removed"))
    return kept, removed


def run_scan(plan: DataFrame, files: DataFrame, responses: DataFrame | None = None, provider=None,
             root: str | None = None, max_chars: int | None = None, model_name: str = P.DEFAULT_MODEL,
             threshold: float = P.LOCATE_THRESHOLD, max_bytes: int = MAX_BUNDLE_BYTES) -> dict:
    """L2: E1 -> M1 -> E2 -> L1 -> F12 -> F2, findings in (suggestion, pipeline, model) order.

    ``files(repo_id, path, text)``.  A finding's path is made relative to ``root`` first
    (F2), then joined to the file table on the relative path.  Bundles are assembled for unanswered requests only
    (and when ``requests`` is read); those above ``max_bytes`` get the ``answer_status`` 'bundle_too_large'.
    ``counts`` holds the run's totals (``findings``, ``located``) as plain numbers.
    """
    ok_plan = plan.filter(F.col("plan_status") == "ok")
    subsets = ok_plan.select("repo_id", "subset_id", "file_paths").distinct()
    index = written(bundle_index(subsets, files, max_chars, root), "bundle-index")
    fits = F.col("bundle_bytes") <= max_bytes
    rows = request_rows(ok_plan, index.filter(fits), model_name)

    def texts(todo: DataFrame) -> DataFrame:
        """Messages of unanswered requests: only their subsets' bundles are assembled."""
        asked = subsets.join(todo.select("repo_id", "subset_id").distinct(), ["repo_id", "subset_id"], "left_semi")
        return with_messages(todo, _assemble(asked, files, index, max_chars, root, max_bytes))

    answered = model.complete(rows, provider=provider, responses=responses, messages_of=texts)
    parsed = parse_findings(answered)
    f = parsed["findings"]
    f = f.withColumn("rel_path", relativize(F.col("file_path"), root) if root else F.col("file_path"))
    f = f.withColumn("finding_id", F.sha1(F.concat_ws("\u0001", "request_id", F.col("pos").cast("string"))))
    # the location step reads findings several times; without the cut each read would build the bundles again
    f = materialize(f)
    located = locate_snippets(
        f.filter(F.col("has_snippet") & F.col("has_path")).select(
            "finding_id", "repo_id", F.col("rel_path").alias("path"), F.col("code_snippet").alias("snippet")),
        files, threshold=threshold,
    )
    f = f.join(located.select("finding_id", "line"), "finding_id", "left").withColumn(
        "line", F.when(F.col("has_snippet") & F.col("has_path"), F.col("line")).otherwise(F.col("model_line"))).drop("model_line")
    # located once: the counts come from the pass that writes the findings, kept and removed ones read what it wrote
    f, counts = observed(f, "findings", findings=F.count(F.lit(1)), located=F.count_if(F.coalesce(F.size("line"), F.lit(-1)) > 0))
    kept, removed = drop_unlocated(f)
    kept = kept.withColumn("file_path", F.col("rel_path")).drop("rel_path")
    status = parsed["answer_status"]
    large = request_rows(ok_plan, index.filter(~fits), model_name).withColumn("answer_status", F.lit("bundle_too_large"))
    return {"findings": kept, "removed": removed, "requests": texts(rows), "stage_outputs": parsed["stage_outputs"],
            "answer_status": status.unionByName(large.select(*status.columns)), "counts": counts}
