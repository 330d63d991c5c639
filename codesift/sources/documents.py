"""JSON and Markdown documents as single files: the typed reader (S6), findings exports of any size (S9, W7), reports.

Files are written by the tasks that hold their rows, under a temporary name first, so a retried task replaces its own file.
The folder must be one that all executors reach and that pyarrow can open (a local or mounted path, ``hdfs://``, ``s3://``, ...).
A document is named by its ``repo_id``, percent-encoded.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift.functions import jsonx
from codesift.operators.metadata import metadata_from_json
from codesift.operators.ordering import ordinal
from codesift.session import materialize
from codesift.sources import artifacts

COPY_BYTES = 8 << 20
EXPORTED = "repo_id string, file string, n_findings bigint"
FRAGMENT = "repo_id string, file string, first bigint, n bigint"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub(r"^file:/+", "/", path).rstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _file_name(name: str, suffix: str = "") -> str:
    return quote(name, safe=" ") + suffix


# --------------------------------------------------------------------------- S6

def _entries(kind: str, v: Column) -> Column:
    if kind == "metadata":
        return F.map_values(F.try_variant_get(v, "$", "map<string, variant>"))
    return jsonx.as_array(jsonx.get_field(v, "vulnerabilities") if kind == "findings" else v)


def _good_entry(kind: str, e: Column) -> Column:
    if kind in ("metadata", "findings"):
        return jsonx.is_object(e)
    named = jsonx.is_object(e) & jsonx.get_string(e, "subset_id").isNotNull()
    if kind == "subsets":
        return named & (~jsonx.has_key(e, "file_paths") | jsonx.is_string_array(jsonx.get_field(e, "file_paths")))
    return named & jsonx.is_string_array(jsonx.get_field(e, "suggested_pipelines"))


READERS = {"subsets": artifacts.subsets_from_json, "suggestions": artifacts.suggestions_from_json,
           "findings": artifacts.findings_from_json, "metadata": metadata_from_json}


def _empty_files(spark: SparkSession, path: str) -> DataFrame:
    """Names of the files without a byte, which Spark's readers leave out (from the driver's listing, like theirs)."""
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [y for x in store.globStatus(glob) or [] for y in (store.listStatus(x.getPath()) if x.isDirectory() else [x])]
    names = [x.getPath().getName() for x in found if x.isFile() and not x.getLen()]
    return spark.createDataFrame([(n, "") for n in names if n[0] not in "._"], "file_name string, json string")


def read_artifact(spark: SparkSession, kind: str, path: str) -> tuple[DataFrame, DataFrame]:
    """The documents ``<repo_id>.json`` of a file, folder or glob as typed rows, and ``(repo_id, file_name, error)`` for those that are not
    what they should be: ``not_json``, ``not_a_document`` (another top level) or ``bad_entry:<position from 0>`` (the first one).

    A bad document gives no row and does not stop the others; a path that does not exist raises ``FileNotFoundError``.
    """
    if kind not in READERS:
        raise ValueError(f"unknown kind {kind!r}; one of {', '.join(READERS)}")
    if not re.search(r"[*?\[{]", path) and not artifacts.path_exists(spark, path):
        raise FileNotFoundError(f"no {kind} at {path}")
    stem = F.regexp_replace("file_name", r"\.json$", "")
    docs = artifacts.read_json_docs(spark, path).unionByName(_empty_files(spark, path)).withColumn("repo_id", artifacts.percent_decode(stem))
    docs = jsonx.with_json(docs, F.col("json")).withColumn("_xs", _entries(kind, F.col("_v")))
    bad = F.array_position(F.transform("_xs", lambda e: _good_entry(kind, e)), False)
    error = (
        F.when(F.col("_v").isNull(), F.lit("not_json")).when(F.col("_xs").isNull(), F.lit("not_a_document"))
        .when(bad > 0, F.concat(F.lit("bad_entry:"), (bad - 1).cast("string")))
    )
    docs = jsonx.settled(docs.withColumn("error", error), "error").select("repo_id", "file_name", "json", "error")
    return READERS[kind](docs.filter("error IS NULL")), docs.filter("error IS NOT NULL").select("repo_id", "file_name", "error")


# --------------------------------------------------------------------------- files

def write_files(docs: DataFrame, out_dir: str) -> DataFrame:
    """``docs(name, text)``: every text as one file ``name`` (percent-encoded) of ``out_dir``.  Returns ``(name, file)``, written."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _open(out_dir)
        store.create_dir(root, recursive=True)
        for b in batches:
            files = []
            for name, text in zip(b["name"], b["text"], strict=True):
                file, part = f"{root}/{_file_name(name)}", f"{root}/_{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write((text or "").encode("utf-8", "surrogatepass"))
                store.move(part, file)
                files.append(file)
            yield pd.DataFrame({"name": b["name"], "file": files})

    named = docs.filter(F.col("name").isNotNull()).select("name", "text")
    return materialize(named.mapInPandas(write, "name string, file string"))


def write_report_files(reports: DataFrame, out_dir: str) -> DataFrame:
    """Every report of ``artifacts.export_reports`` as one Markdown file; the rows of the result are the count."""
    return write_files(reports.select(F.col("md_name").alias("name"), F.col("content").alias("text")), out_dir)


# --------------------------------------------------------------------------- S9

def export_findings(findings: DataFrame, out_dir: str) -> DataFrame:
    """S9 + W7: ``out_dir/<repo_id>.json`` = ``{"vulnerabilities": [...]}`` for every repository, in suggestion, pipeline and model order.

    No document is ever a value: findings are numbered across tasks, sorted ranges of them are written as fragments whose
    separators follow from the numbers, and a repository's fragments are copied behind each other as bytes.  Returns
    ``(repo_id, file, n_findings)``.  A null ``repo_id`` raises.
    """
    fields = ["file_path", "code_snippet", "description", "vulnerability", "severity", "confidence_level", "remediation", "line"]
    repo = F.when(F.col("repo_id").isNull(), F.raise_error(F.lit("a finding without repo_id"))).otherwise(F.col("repo_id"))
    rows = findings.select(repo.alias("repo_id"), "suggestion_no", "pipeline_pos", "pos", F.to_json(F.struct(*fields)).alias("entry"))
    numbered = ordinal(rows, ["repo_id"], ["suggestion_no", "pipeline_pos", "pos", "entry"], "n").select("repo_id", "n", "entry")
    total = numbered.groupBy("repo_id").agg(F.max("n").alias("total"))
    text = F.concat(F.when(F.col("n") == 1, F.lit('{"vulnerabilities": [\n')).otherwise(F.lit(",\n")), F.col("entry"),
                    F.when(F.col("n") == F.col("total"), F.lit("\n]}\n")).otherwise(F.lit("")))
    pieces = numbered.join(total, "repo_id").select("repo_id", "n", text.alias("text"))
    pieces = pieces.repartitionByRange("repo_id", "n").sortWithinPartitions("repo_id", "n")
    scratch = f"_fragments-{uuid.uuid4().hex}"

    def fragments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Consecutive findings of one repository and task as one file, named by the first one's number."""
        store, root = _open(out_dir)
        out, now, done = None, None, []

        def close():
            if out is not None:
                out.close()
                store.move(now["part"], now["file"])
                done.append((now["repo_id"], now["file"], now["first"], now["n"]))

        for b in batches:
            for repo_id, n, piece in zip(b["repo_id"], b["n"], b["text"], strict=True):
                if now is None or now["repo_id"] != repo_id:
                    close()
                    folder = f"{root}/{scratch}/{_file_name(repo_id)}"
                    store.create_dir(folder, recursive=True)
                    now = {"repo_id": repo_id, "file": f"{folder}/{n:020d}", "part": f"{folder}/_{uuid.uuid4().hex}", "first": n, "n": 0}
                    out = store.open_output_stream(now["part"])
                out.write(piece.encode("utf-8", "surrogatepass"))
                now["n"] += 1
        close()
        yield pd.DataFrame(done, columns=["repo_id", "file", "first", "n"])

    def join(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        """The files of one repository (one row per task that wrote it) copied into its document."""
        store, root = _open(out_dir)
        file, part = f"{root}/{_file_name(key[0], '.json')}", f"{root}/_{uuid.uuid4().hex}"
        with store.open_output_stream(part) as out:
            for piece in parts.sort_values("first")["file"]:
                with store.open_input_stream(piece) as source:
                    while block := source.read(COPY_BYTES):
                        out.write(block)
        store.move(part, file)
        return pd.DataFrame({"repo_id": [key[0]], "file": [file], "n_findings": [int(parts["n"].sum())]})

    written = materialize(pieces.mapInPandas(fragments, FRAGMENT))
    store, root = _open(out_dir)
    store.create_dir(root, recursive=True)
    out = materialize(written.groupBy("repo_id").applyInPandas(join, EXPORTED))
    if store.get_file_info(f"{root}/{scratch}").type == fs.FileType.Directory:
        store.delete_dir(f"{root}/{scratch}")
    return out
