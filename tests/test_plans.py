"""Plan shape checks: the properties PLANS.md relies on stay true."""

from pyspark.sql import functions as F

from codesift.functions import jsonx
from codesift.operators import metadata, ordering, selection
from codesift.sources.corpus import corpus
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_is_jvm_only_and_pruned(spark):
    df = metadata.profile(selection.path_prefilter(corpus(spark, SF_SMALL)))
    plan = _plan(df.select("repo_id", "language", "loc", "token_estimate", "sha1"))
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in plan   # lang, n_chars pruned


def test_head_n_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("o"))
    top = ordering.head_n(df, 3, ["g"], ["o"], remainder=False)
    plan = top._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_selection_prompt_reads_no_text(spark):
    plan = _plan(selection.selection_requests(selection.path_prefilter(corpus(spark, SF_SMALL))))
    assert "text:string" not in plan


def test_strict_json_is_parsed_once(spark):
    df = spark.createDataFrame([("[1]",), ("no",)], "content string")
    rows = jsonx.with_json(df, F.col("content"))
    kind = F.when(jsonx.is_array(F.col("_v")), "list").when(F.col("_v").isNull(), "none")
    plan = _plan(rows.withColumn("kind", kind).filter("kind = 'list' OR kind = 'none'").select("kind"))
    assert plan.count("ArrowEvalPython [") == 1 and plan.count("try_parse_json") <= 4


def test_metadata_reads_the_texts_once(spark):
    """Everything that a metadata build returns stands on one written table of the current files."""
    files = corpus(spark, SF_SMALL)
    assert "documents.parquet" in _plan(files)
    chosen = files.select("repo_id", F.lit(1).cast("bigint").alias("pos"), "path")
    out = metadata.build_metadata(chosen, files, None)
    for name in ("metadata", "processed", "requests"):
        plan = _plan(out[name])
        assert "documents.parquet" not in plan, name
