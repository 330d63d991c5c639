"""The whole triage as one chain of lazy DataFrames (the six steps of the original tool):
list -> select -> metadata -> group -> suggest -> scan and locate.

This is only the order in which the operators are composed; each step is usable alone.
Model answers come from ``responses`` (stored, replayed by request hash) and/or a
``provider``; every provider call result is checkpointed before use.  Tables that
several later steps read (metadata, subsets) are checkpointed as well, so their
lineage is cut and a lost executor recomputes nothing upstream of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.operators import grouping, metadata, metrics, scan, selection, suggest
from codesift.plans import model
from codesift.plans import prompts as P
from codesift.plans.catalog import catalog_frame
from codesift.session import materialize
from codesift.sources.listing import scan_corpus


STEP_MODELS = {"select": P.DEFAULT_MODEL, "summary": P.SUMMARY_MODEL, "group": P.DEFAULT_MODEL,
               "suggest": P.DEFAULT_MODEL, "scan": P.DEFAULT_MODEL}


def triage(files: DataFrame, provider=None, responses: DataFrame | None = None,
           prev_metadata: DataFrame | None = None, catalog: DataFrame | None = None, root: str | None = None,
           depth: int | None = None, select_limit: int | None = None, metadata_max_files: int | None = None,
           chunk_size: int = P.FILES_PER_GROUPING_PROMPT, files_per_suggestion: int | None = None,
           max_chars: int | None = None, models: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """``files(repo_id, path, content)`` for every repository -> all artifacts of a run.

    Every file takes part; the original tool's limits are arguments.  ``models`` overrides the model
    of a step (keys of ``STEP_MODELS``).  A repository of which a grouping chunk got no usable
    answer is held back: ``held_back`` lists it, and it gets neither suggestions nor findings until a
    later run answers the chunk.
    """
    spark = files.sparkSession
    model_of = {**STEP_MODELS, **(models or {})}
    catalog = catalog if catalog is not None else catalog_frame(spark)

    listed = scan_corpus(files.select("repo_id", "path"), depth=depth)                       # S1
    kept = selection.path_prefilter(selection.flattened(listed))                             # S3, F1
    sel_req = selection.selection_requests(kept, select_limit, model_of["select"])           # G2
    sel_ans = model.complete(sel_req, provider=provider, responses=responses)                # M1
    paths = kept.select("repo_id", "path")
    if select_limit is None:
        picked = selection.batched_selection_result(paths, sel_ans)
    else:
        picked = selection.selection_result(paths, sel_ans.select("repo_id", "content"))
    chosen = materialize(picked)                                                             # G3

    meta = metadata.build_metadata(chosen, files, prev_metadata, responses=responses, provider=provider,
                                   max_files=metadata_max_files, model_name=model_of["summary"])     # G4
    table = materialize(meta["metadata"])

    grp_req = grouping.grouping_requests(table, chunk_size, model_of["group"])              # G6
    grp_ans = model.complete(grp_req, provider=provider, responses=responses)
    grouped = grouping.parse_grouping(grp_ans.select("repo_id", "chunk", "content"))         # G7
    subsets = materialize(grouped["subsets"].join(grouped["ok_repos"], "repo_id", "left_semi"))
    held_back = table.select("repo_id").distinct().join(grouped["ok_repos"], "repo_id", "left_anti")

    sug_req = suggest.suggestion_requests(subsets, table, catalog, files_per_suggestion, model_of["suggest"])   # P2
    sug_ans = model.complete(sug_req, provider=provider, responses=responses)
    suggestions = suggest.parse_suggestions(sug_ans.select("repo_id", "subset_id", "subset_no", "content"))  # P3
    plan = materialize(scan.plan_runs(suggestions.select("repo_id", "subset_id", "subset_no", "suggested_pipelines"),
                                      subsets, catalog))                                     # J6

    texts = metadata.profile(files).select("repo_id", "path", "text")
    scanned = scan.run_scan(plan, texts, responses=responses, provider=provider, root=root,
                            max_chars=max_chars, model_name=model_of["scan"])                # L2
    findings = scanned["findings"]
    counters = metrics.stage_metrics({
        "listed": listed, "kept": kept, "selected": chosen, "metadata_files": table,
        "subsets": subsets, "findings": findings,
    })                                                                                       # A4
    return {
        "listed": listed, "kept": kept, "selection_requests": sel_req, "selection": chosen,
        "missing": meta["missing"], "metadata": table, "metadata_requests": meta["requests"],
        "grouping_requests": grp_req, "chunk_status": grouped["chunk_status"], "held_back": held_back, "subsets": subsets,
        "suggestion_requests": sug_req, "suggestions": suggestions, "plan": plan,
        "scan_requests": scanned["requests"], "stage_outputs": scanned["stage_outputs"],
        "findings": findings, "removed": scanned["removed"], "metrics": counters,
    }
