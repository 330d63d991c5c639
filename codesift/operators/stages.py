"""K2: pipelines of several stages (detect, then remediate, ...), run level by level.

A stage with ``inject_previous_output`` reads the saved output of the stage of its pipeline whose ``output_tag`` is its
``input_tag`` (of several the last).  The stages of a catalog are a graph in rows; every stage gets a level (0 without
input, else one above its producer) or a status that says why it cannot run:

* ``unknown_tag``: no stage of the pipeline saves an output under that tag;
* ``blocked``: its producer, or a producer before that, has an unknown tag;
* ``cycle``: it waits for itself, or for stages that do.

A level is one round of E1, M1 and E2 over all subsets and pipelines; its saved outputs are joined to the next
level's requests.  Rounds number the depth of the deepest pipeline, not the subsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.operators import scan
from codesift.plans import model
from codesift.plans import prompts as P
from codesift.session import materialize

INPUT_HEAD = "\n\nOutput of the previous stage ("
INPUT_MID = "):\n```json\n"
INPUT_TAIL = "\n```"
OUTPUT_KEYS = ["repo_id", "subset_id", "pipeline_id"]
OUTPUTS = "repo_id string, subset_id string, pipeline_id string, output_tag string, payload string"


def stage_graph(catalog: DataFrame) -> DataFrame:
    """(pipeline_id, stage_no, stage, producer_no, level, stage_status), one row per stage of the catalog."""
    stages = catalog.select("pipeline_id", F.posexplode("stages").alias("stage_no", "stage"))
    needs = F.coalesce(F.col("stage.inject_previous_output"), F.lit(False))
    producers = stages.filter("stage.save_output AND stage.output_tag IS NOT NULL").groupBy(
        "pipeline_id", F.col("stage.output_tag").alias("_tag")).agg(F.max("stage_no").alias("producer_no"))
    nodes = stages.withColumn("_tag", F.when(needs, F.coalesce(F.col("stage.input_tag"), F.lit("")))) \
        .join(producers, ["pipeline_id", "_tag"], "left").select("pipeline_id", "stage_no", "stage", "_tag", "producer_no")
    nodes = materialize(nodes)
    # one round per level: a stage is reached when its producer is
    reached = nodes.filter("producer_no IS NULL").select(
        "pipeline_id", "stage_no", F.lit(0).alias("level"),
        F.when(F.col("_tag").isNull(), F.lit("ok")).otherwise(F.lit("unknown_tag")).alias("stage_status"))
    front = reached = materialize(reached)
    while not front.isEmpty():
        front = materialize(nodes.select("pipeline_id", "stage_no", "producer_no").join(
            front.select("pipeline_id", F.col("stage_no").alias("producer_no"), "level", "stage_status"), ["pipeline_id", "producer_no"]).select(
            "pipeline_id", "stage_no", F.col("level") + 1,
            F.when(F.col("stage_status") == "ok", F.lit("ok")).otherwise(F.lit("blocked")).alias("stage_status")).toDF(*reached.columns))
        reached = reached.unionByName(front)
    return nodes.join(reached, ["pipeline_id", "stage_no"], "left").select(
        "pipeline_id", "stage_no", "stage", "producer_no",
        F.when(F.col("stage_status") == "ok", F.col("level")).alias("level"),
        F.coalesce("stage_status", F.lit("cycle")).alias("stage_status"))


def stage_requests(todo: DataFrame, bundles: DataFrame, model_name: str = P.DEFAULT_MODEL) -> DataFrame:
    """E1 for stages: the subset's bundle and, where a row has an ``input``, the previous stage's output behind it."""
    extra = F.when(F.col("input").isNotNull(), F.concat(
        F.lit(INPUT_HEAD), F.col("stage.input_tag"), F.lit(INPUT_MID), F.col("input"), F.lit(INPUT_TAIL))).otherwise("")
    return scan.scan_requests(todo, bundles, model_name, extra)


def run_stages(plan: DataFrame, catalog: DataFrame, files: DataFrame, responses: DataFrame | None = None, provider=None,
               saved: DataFrame | None = None, root: str | None = None, max_chars: int | None = None,
               model_name: str = P.DEFAULT_MODEL, journal: str | None = None,
               max_bytes: int = scan.MAX_BUNDLE_BYTES) -> dict[str, DataFrame]:
    """``plan`` (from ``scan.plan_runs``) with all stages of its pipelines.

    ``saved`` (see ``OUTPUTS``) are outputs of earlier runs; an output of this run goes before them.  Returns ``stages`` (one row
    per planned stage with its status: those of the graph, ``missing_input`` if the producer left no output, ``bundle_too_large``, ``ok``), the
    ``requests`` and ``responses`` of all levels, ``outputs`` and the ``findings`` of stages whose output no other stage reads.
    """
    spark = plan.sparkSession
    graph = materialize(stage_graph(catalog))
    read = graph.filter("stage_status = 'ok'").select("pipeline_id", F.col("producer_no").alias("stage_no"), F.lit(True).alias("_read")).distinct()
    graph = graph.join(read, ["pipeline_id", "stage_no"], "left").withColumn("last", F.col("_read").isNull()).drop("_read")
    planned = materialize(plan.filter(F.col("plan_status") == "ok").drop("stage").join(graph, "pipeline_id"))
    bundles = materialize(scan.bundle_context(
        planned.filter("stage_status = 'ok'").select("repo_id", "subset_id", "file_paths").distinct(), files, max_chars=max_chars, root=root, max_bytes=max_bytes))
    large = bundles.filter("bundle_status <> 'ok'").select("repo_id", "subset_id", "bundle_status")
    runs = (F.col("stage_status") == "ok") & F.col("bundle_status").isNull()
    planned = planned.join(large, ["repo_id", "subset_id"], "left").withColumn("level", F.when(runs, F.col("level"))).withColumn(
        "stage_status", F.when((F.col("stage_status") == "ok") & ~runs, F.lit("bundle_too_large")).otherwise(F.col("stage_status"))).drop("bundle_status")
    depth = graph.agg(F.max("level")).first()[0]
    outputs = (saved if saved is not None else spark.createDataFrame([], OUTPUTS)).select(*OUTPUT_KEYS, "output_tag", "payload")
    rounds = []
    for level in range(-1 if depth is None else depth + 1):
        todo = planned.filter(F.col("level") == level)
        if level:
            told = outputs.select(*OUTPUT_KEYS, F.col("output_tag").alias("_tag"), F.col("payload").alias("input"))
            todo = todo.withColumn("_tag", F.col("stage.input_tag")).join(told, [*OUTPUT_KEYS, "_tag"], "left").drop("_tag")
        else:
            todo = todo.withColumn("input", F.lit(None).cast("string"))
        fed = F.col("producer_no").isNull() | F.col("input").isNotNull()
        reqs = stage_requests(todo.filter(fed), bundles, model_name)
        answered = materialize(model.complete(reqs, provider=provider, responses=responses, journal=journal))
        parsed = scan.parse_findings(answered)
        new = parsed["stage_outputs"].filter("save_output").select(*OUTPUT_KEYS, "output_tag", "payload")
        outputs = materialize(outputs.join(new, [*OUTPUT_KEYS, "output_tag"], "left_anti").unionByName(new))
        rounds.append({"answered": answered, "starved": todo.filter(~fed), "findings": parsed["findings"], "status": parsed["answer_status"]})
    cols = [*OUTPUT_KEYS, "stage_no", F.col("stage.id").alias("stage_id"), "level"]
    status = planned.filter("level IS NULL").select(*cols, "stage_status", F.lit(None).cast("string").alias("request_id"))
    for r in rounds:
        status = status.unionByName(r["answered"].select(
            *cols, F.when(F.col("status") == "ok", F.lit("ok")).otherwise(F.lit("no_answer")).alias("stage_status"), "request_id"))
        status = status.unionByName(r["starved"].select(*cols, F.lit("missing_input").alias("stage_status"), F.lit(None).cast("string").alias("request_id")))
    last = planned.filter("last").select(*OUTPUT_KEYS, "stage_no")
    found, requests, answers = None, None, None
    for r in rounds:
        f = r["findings"].join(last, [*OUTPUT_KEYS, "stage_no"], "left_semi")
        a = r["answered"].select("request_id", "content", "status")
        found = f if found is None else found.unionByName(f)
        requests = r["answered"] if requests is None else requests.unionByName(r["answered"])
        answers = a if answers is None else answers.unionByName(a)
    return {"stages": status, "outputs": outputs, "findings": found, "requests": requests, "responses": answers}
