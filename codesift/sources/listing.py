"""Listing files, the directory tree as a table, and reading a stored tree.

``spark.read.format("binaryFile")`` skips every name that starts with '_' or '.'
(``.env``, ``__init__.py``), so files are listed and read by Python tasks
(``mapInPandas``) instead.  The walk goes by a frontier of directories that is dealt to
the tasks in rounds, large directories in slices, so one big repository or directory is
walked by many tasks; file bytes are read by the tasks that own
the path rows, after path filters ran.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codesift.functions.paths import FLATTEN_EXCLUDE_DIRS, TREE_EXCLUDE_DIRS, ancestor_dirs, base_name, parent_dirs
from codesift.session import spread, written

WALK_SCHEMA = T.StructType([
    T.StructField("repo_id", T.StringType()),
    T.StructField("root", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("depth_left", T.IntegerType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("parts", T.IntegerType()),
    T.StructField("task", T.IntegerType()),
])
CONTENT_SCHEMA = T.StructType([
    T.StructField("repo_id", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("content", T.BinaryType()),
])


#: Bytes of file content that one Arrow batch of ``read_contents`` gathers before it is sent on.
READ_BATCH_BYTES = 64 << 20


#: A directory with more entries is listed in slices of about this many, by as many tasks.
SLICE_ENTRIES = 50_000
#: Entries that one frontier row walks before it hands its remaining directories to the next round.
ROW_ENTRIES = 50_000


def _entries(here: str, part: int, parts: int) -> Iterator[tuple[str, bool]]:
    """(name, is a directory) of one slice of a directory; slices are by name, so each entry is in exactly one."""
    with os.scandir(here) as found:
        for entry in found:
            if parts == 1 or zlib.crc32(os.fsencode(entry.name)) % parts == part:
                try:
                    yield entry.name, entry.is_dir()
                except OSError:
                    yield entry.name, False


def _walk(root: str, start: tuple, exclude: frozenset, slice_entries: int, row_entries: int) -> Iterator[tuple]:
    """One frontier row: ``(kind, path, depth_left, part, parts)`` with kind 'file', or 'todo' for what the next round walks.

    Excluded directories and those deeper than allowed are not entered, unreadable ones are skipped whole.
    """
    stack, seen = [start], 0
    while stack:
        rel, left, part, parts = stack.pop()
        if seen >= row_entries:
            yield "todo", rel, left, part, parts
            continue
        here = os.path.join(root, rel) if rel else root
        try:
            if parts == 1:
                with os.scandir(here) as found:
                    n = sum(1 for _ in found)
                if n > slice_entries:
                    k = -(-n // slice_entries)
                    yield from (("todo", rel, left, i, k) for i in range(k))
                    continue
            for name, is_dir in _entries(here, part, parts):
                seen += 1
                child = f"{rel}/{name}" if rel else name
                if not is_dir:
                    yield "file", child, None, 0, 1
                elif name not in exclude and (left is None or left > 0):
                    stack.append((child, None if left is None else left - 1, 0, 1))
        except OSError:
            continue


def walk_rounds(roots: DataFrame, depth: int | None = None, exclude_dirs: list[str] | None = None,
                slice_entries: int = SLICE_ENTRIES, row_entries: int = ROW_ENTRIES) -> DataFrame:
    """The walk of ``list_files`` as rows of ``WALK_SCHEMA`` with the round and task that made them.

    The frontier (directories, or slices of large ones) is dealt to the tasks anew in every round; a row stops after
    ``row_entries`` entries, so rounds number the walk's size per row, not the depth of the tree.  Every round is written.
    """
    exclude = frozenset(TREE_EXCLUDE_DIRS if exclude_dirs is None else exclude_dirs)

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols, task = WALK_SCHEMA.names, TaskContext.get().partitionId()
        out = []
        for pdf in batches:
            for repo_id, root, rel, left, part, parts in pdf.itertuples(index=False):
                start = (rel, None if pd.isna(left) else int(left), part, parts)
                for row in _walk(root, start, exclude, slice_entries, row_entries):
                    out.append((repo_id, root, *row, task))
                    if len(out) >= 10_000:  # bounded Arrow batches for huge directories
                        yield pd.DataFrame(out, columns=cols).astype({"depth_left": "Int32"})
                        out = []
        yield pd.DataFrame(out, columns=cols).astype({"depth_left": "Int32"})

    frontier = roots.filter(F.col("root").isNotNull()).select(
        "repo_id", "root", F.lit("").alias("path"), F.lit(depth).cast("int").alias("depth_left"), F.lit(0).alias("part"), F.lit(1).alias("parts"))
    rounds, n = None, 0
    while True:
        rows = written(spread(frontier, "repo_id", "path", "part").mapInPandas(step, WALK_SCHEMA), "walk")
        told = rows.withColumn("round", F.lit(n))
        rounds, n = told if rounds is None else rounds.unionByName(told), n + 1
        frontier = rows.filter("kind = 'todo'").select("repo_id", "root", "path", "depth_left", "part", "parts")
        if frontier.isEmpty():
            return rounds


def list_files(roots: DataFrame, depth: int | None = None, exclude_dirs: list[str] | None = None) -> DataFrame:
    """``roots(repo_id, root)`` -> ``listing(repo_id, root, path)`` of regular files.

    A file is kept iff none of its directory components is an excluded name and, if ``depth`` is
    given, it has at most that many (the root itself is depth 0).  Roots must be on storage that
    every executor mounts.  The walk runs when this is called (``walk_rounds``).
    """
    return walk_rounds(roots, depth, exclude_dirs).filter("kind = 'file'").select("repo_id", "root", "path")


def read_contents(listing: DataFrame) -> DataFrame:
    """Bytes of each listed file: ``(repo_id, root, path)`` -> ``(repo_id, path, content)``.

    Run path filters before this so excluded files are never read; unreadable files give null.
    A batch is handed on as soon as it holds ``READ_BATCH_BYTES``.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["repo_id", "path", "content"]
        rows, held = [], 0
        for pdf in batches:
            for repo_id, root, path in zip(pdf["repo_id"], pdf["root"], pdf["path"]):
                try:
                    with open(os.path.join(root, path), "rb") as fh:
                        data = fh.read()
                except OSError:
                    data = None
                rows.append((repo_id, path, data))
                held += len(data or b"")
                if held >= READ_BATCH_BYTES or len(rows) >= 10_000:
                    yield pd.DataFrame(rows, columns=cols)
                    rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=cols)

    return listing.select("repo_id", "root", "path").mapInPandas(read, CONTENT_SCHEMA)


def scan_corpus(files: DataFrame, exclude_dirs: list[str] | None = None, depth: int | None = None) -> DataFrame:
    """S1 over a path table: adds ``dirs``/``name`` and keeps files whose directory parts are
    not excluded and, if ``depth`` is given, number at most ``depth``."""
    excl = TREE_EXCLUDE_DIRS if exclude_dirs is None else exclude_dirs
    dirs = parent_dirs(F.col("path"))
    excl_arr = F.array(*[F.lit(x) for x in excl]) if excl else F.array().cast("array<string>")
    return (
        files.withColumn("dirs", dirs)
        .withColumn("name", base_name(F.col("path")))
        .filter(~F.arrays_overlap(F.col("dirs"), excl_arr) & (F.lit(True) if depth is None else F.size("dirs") <= depth))
    )


def tree_edges(files: DataFrame) -> DataFrame:
    """The tree as parent -> child rows ``(repo_id, parent, name, kind, depth)``.

    Directories appear once (deduplicated with a partial aggregate); empty directories
    cannot appear, as in the nested form.  Nothing is collected per directory, so a
    directory holding millions of files is just many rows.
    """
    file_rows = files.select(
        "repo_id",
        F.array_join(parent_dirs(F.col("path")), "/").alias("parent"),
        base_name(F.col("path")).alias("name"),
        F.lit("file").alias("kind"),
        F.size(parent_dirs(F.col("path"))).alias("depth"),
    )
    anc = files.select("repo_id", F.posexplode(ancestor_dirs(F.col("path"))).alias("lvl", "dir"))
    dir_rows = (
        anc.filter(F.col("lvl") > 0)
        .select(
            "repo_id",
            F.array_join(parent_dirs(F.col("dir")), "/").alias("parent"),
            base_name(F.col("dir")).alias("name"),
            F.lit("dir").alias("kind"),
            (F.col("lvl") - 1).alias("depth"),
        )
        .distinct()
    )
    return file_rows.unionByName(dir_rows)


def flatten_tree(trees: DataFrame, exclude_dirs: list[str] | None = None) -> DataFrame:
    """S3: stored nested trees ``(repo_id, tree_json)`` -> ``(repo_id, path)``.

    ``{dir: {...}, "__files__": [names]}``: names under ``__files__`` are files of that
    directory; excluded directory names are skipped at any level; non-object values are
    ignored.  The nested document is the original tool's import format and arrives as one
    row per repository; the walk itself is a recursive CTE over VARIANT.
    """
    excl = FLATTEN_EXCLUDE_DIRS if exclude_dirs is None else exclude_dirs
    spark = trees.sparkSession
    view = f"codesift_trees_{uuid.uuid4().hex}"
    trees.select("repo_id", F.parse_json("tree_json").alias("node")).createOrReplaceTempView(view)
    excl_sql = ", ".join("'" + x.replace("'", "''") + "'" for x in excl) or "NULL"
    sql = f"""
    WITH RECURSIVE walk(repo_id, prefix, node) AS (
      SELECT repo_id, '' AS prefix, node FROM {view}
      UNION ALL
      SELECT w.repo_id, concat(w.prefix, e.key, '/'), e.value
      FROM walk w, LATERAL variant_explode(w.node) AS e
      WHERE e.key <> '__files__' AND NOT array_contains(array({excl_sql}), e.key)
        AND schema_of_variant(e.value) LIKE 'OBJECT%'
    )
    SELECT w.repo_id, concat(w.prefix, variant_get(f.value, '$', 'string')) AS path
    FROM walk w, LATERAL variant_explode(w.node) AS k, LATERAL variant_explode(k.value) AS f
    WHERE k.key = '__files__' AND schema_of_variant(f.value) = 'STRING'
    """
    try:
        return spark.sql(sql)  # the plan holds the view's rows from here on
    finally:
        spark.catalog.dropTempView(view)
