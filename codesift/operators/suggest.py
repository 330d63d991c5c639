"""Pipeline suggestions: J5/T9/P1 subset_summary, T10 render_pipeline_line / catalog_text,
P2 suggestion_requests, P3 parse_suggestions, A6 subset_sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesift.functions import jsonx
from codesift.functions.text import py_strip
from codesift.operators.grouping import join_lines
from codesift.plans import model
from codesift.plans import prompts as P
from codesift.plans.catalog import MAX_CATALOG_ROWS


def render_subset_line(path: Column, side: Column, lang: Column, desc: Column) -> Column:
    """T9: '• path [side/lang]: description' (missing metadata gives empty fields)."""
    return F.concat(F.lit("• "), path, F.lit(" ["), F.coalesce(side, F.lit("")), F.lit("/"),
                    F.coalesce(lang, F.lit("")), F.lit("]: "), F.coalesce(desc, F.lit("")))


def render_pipeline_line(pid: Column, desc: Column, targets: Column) -> Column:
    """T10: '- id: description (targets a, b)'."""
    return F.concat(F.lit("- "), pid, F.lit(": "), desc, F.lit(" (targets "),
                    F.array_join(targets, ", "), F.lit(")"))


def subset_sizes(subsets: DataFrame) -> DataFrame:
    """Number of listed paths per subset."""
    return subsets.select("repo_id", "subset_id", F.size("file_paths").cast("bigint").alias("n_files"))


def subset_summary(subsets: DataFrame, metadata: DataFrame, cap: int | None = None) -> DataFrame:
    """Per subset, its paths rendered with their metadata (J5: left join, missing -> ''); with
    ``cap`` only the first ones, then '… K more files omitted for brevity …' when longer."""
    members = subsets.select("repo_id", "subset_id", F.posexplode("file_paths").alias("fpos", "path"))
    if cap is not None:
        members = members.filter(F.col("fpos") < cap)
    meta = metadata.select("repo_id", "path", "side", "language", "description")
    lines = members.join(meta, ["repo_id", "path"], "left").withColumn(
        "line", render_subset_line(F.col("path"), F.col("side"), F.col("language"), F.col("description"))
    )
    text = join_lines(lines, ["repo_id", "subset_id"], "line", "fpos", "summary")
    sized = subsets.select("repo_id", "subset_id", F.size("file_paths").alias("_n"))
    if cap is None:
        return sized.join(text, ["repo_id", "subset_id"], "left").select(
            "repo_id", "subset_id", F.coalesce(F.col("summary"), F.lit("")).alias("summary"))
    omitted = F.format_string(P.SUBSET_OMITTED.replace("{n}", "%d"), F.col("_n") - cap)
    return (
        sized.join(text, ["repo_id", "subset_id"], "left")
        .withColumn("summary", F.coalesce(F.col("summary"), F.lit("")))
        .withColumn("summary", F.when(F.col("_n") > cap,
                                      F.when(F.col("summary") == "", omitted)
                                      .otherwise(F.concat(F.col("summary"), F.lit("\n"), omitted)))
                    .otherwise(F.col("summary")))
        .drop("_n")
    )


def catalog_text(catalog: DataFrame) -> str:
    """T10 over the whole catalog, in catalog order.  The catalog is a size-checked
    configuration table (see ``catalog_frame``); its rendering is one short string that
    every suggestion request embeds as a literal."""
    if catalog.limit(MAX_CATALOG_ROWS + 1).count() > MAX_CATALOG_ROWS:
        raise ValueError(f"a catalog has at most {MAX_CATALOG_ROWS} pipelines")
    row = (
        catalog.select("pipeline_pos", render_pipeline_line(F.col("pipeline_id"), F.col("description"),
                                                            F.col("target_vulnerabilities")).alias("line"))
        .agg(F.expr("listagg(line, '\\n') WITHIN GROUP (ORDER BY pipeline_pos)").alias("text"))
        .first()
    )
    return (row["text"] if row else None) or ""


def suggestion_requests(subsets: DataFrame, metadata: DataFrame, catalog: DataFrame,
                        cap: int | None = None, model_name: str = P.DEFAULT_MODEL) -> DataFrame:
    """One request per subset: catalog list in the system message, subset summary in the user one."""
    system = P.SUGGEST_SYSTEM_HEAD + catalog_text(catalog) + P.SUGGEST_SYSTEM_TAIL
    summ = subset_summary(subsets, metadata, cap)
    user = F.concat(F.lit(P.SUGGEST_USER_HEAD), F.col("summary"), F.lit(P.SUGGEST_USER_TAIL))
    prm = model.params(model_name, temperature=P.SUGGEST_TEMPERATURE, max_tokens=P.SUGGEST_MAX_TOKENS)
    keyed = subsets.select("repo_id", "subset_id", "subset_no").join(summ, ["repo_id", "subset_id"], "inner")
    return model.with_request(keyed, P.OP_SUGGEST, F.lit(system), user, prm)


def parse_suggestions(answered: DataFrame, content: str = "content") -> DataFrame:
    """A JSON list gives its string items (``[]`` stays empty); anything else, fenced
    answers included, gives ``["pipeline_injection"]``.  Adds ``suggested_pipelines``."""
    v = F.col("_v")
    fallback = F.array(F.lit(P.DEFAULT_PIPELINE))
    return jsonx.with_json(answered, py_strip(F.col(content))).withColumn(
        "suggested_pipelines", F.when(jsonx.is_array(v), jsonx.string_items(v)).otherwise(fallback)
    ).drop("_v")
