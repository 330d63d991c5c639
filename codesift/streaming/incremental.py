"""Incremental corpus scan with Structured Streaming.

New or changed files dropped as Parquet ``(repo_id, path, content, seq)`` into a folder update the metadata table.  What is
known of a file (its ``seq`` and SHA-1) lives in a state store keyed by ``(repo_id, path)``, so a micro-batch costs what
its own rows cost, however long the history is:

* the stateful step keeps the newest version of each path of the batch (highest ``seq``; of equal ones the larger content),
  drops versions older than the state's, and tells new, changed, unchanged and deleted files (J3);
* ``process_batch`` profiles the new and changed ones, asks for their summaries (M1) and appends its rows to a log
  partitioned by ``batch_id``.  Writing a batch overwrites only its own folder, so a replayed epoch is idempotent;
* files whose summary failed are listed in a pending table (one version per batch that changes it) and count as changed when they
  are dropped again, with the same bytes too.  Its size is the number of open failures.

A row without content deletes its path.  With ``expire_deleted_ms`` a timer forgets a deleted path after that time; until then
older versions that arrive late stay out.  The current table is the latest row per path over the newest snapshot
(``compact``) and the log behind it.  Beside ``state_dir`` lie ``<state_dir>_pending``, ``_snapshot`` and ``_work``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from codesift.operators.metadata import METADATA_SCHEMA, parse_summary, profile, summary_requests
from codesift.plans import model

DROP_SCHEMA = T.StructType([
    T.StructField("repo_id", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("seq", T.LongType()),
])
EVENT_SCHEMA = T.StructType([*DROP_SCHEMA.fields, T.StructField("sha1", T.StringType()), T.StructField("change", T.StringType())])
FILE_STATE = "seq bigint, sha1 string"
PENDING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("repo_id", "path", "sha1")])

LOG_SCHEMA = T.StructType([f for f in METADATA_SCHEMA.fields if f.name != "ord"] + [
    T.StructField("change", T.StringType()), T.StructField("summary_status", T.StringType())])
STATE_COLUMNS = [f.name for f in LOG_SCHEMA.fields]

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Most rows and bytes of an Arrow batch between Spark and the stateful step; a worker holds about one each way.
FRAME_ROWS, FRAME_BYTES = 500, 8 << 20


def _folders(spark: SparkSession, path: str) -> dict[int, str]:
    """The ``batch_id=<n>`` folders of a table, by number; empty when there is no table yet."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(root):
        return {}
    names = [x.getPath().getName() for x in store.listStatus(root)]
    return {int(n.split("=")[1]): f"{path}/{n}" for n in names if n.startswith("batch_id=")}


def _remove(spark: SparkSession, path: str) -> None:
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def _log(spark: SparkSession, state_dir: str, after: int) -> DataFrame:
    """Rows of the log behind batch ``after``, with their ``batch_id``."""
    base = state_dir.rstrip("/")
    schema = T.StructType([*LOG_SCHEMA.fields, T.StructField("batch_id", T.LongType())])
    parts = [p for n, p in _folders(spark, base).items() if n > after]
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*parts)


def _latest(spark: SparkSession, state_dir: str) -> DataFrame:
    """Latest row per (repo_id, path), deleted ones included, over the newest snapshot and the log behind it."""
    shots = _folders(spark, state_dir.rstrip("/") + "_snapshot")
    upto = max(shots, default=-1)
    rows = _log(spark, state_dir, upto)
    if shots:
        rows = spark.read.schema(LOG_SCHEMA).parquet(shots[upto]).withColumn("batch_id", F.lit(upto).cast("bigint")).unionByName(rows)
    rest = [c for c in STATE_COLUMNS if c not in ("repo_id", "path")]
    latest = rows.groupBy("repo_id", "path").agg(F.max_by(F.struct(*rest), "batch_id").alias("r"))
    return latest.select("repo_id", "path", *[F.col("r")[c].alias(c) for c in rest])


def current_metadata(spark: SparkSession, state_dir: str) -> DataFrame:
    """Latest row per (repo_id, path) that is not deleted (a partial aggregate)."""
    return _latest(spark, state_dir).filter(F.col("change") != "deleted")


def compact(spark: SparkSession, state_dir: str) -> int:
    """Write the current table as a snapshot of all finished batches and drop the log folders and snapshots it replaces.

    Run it between runs of the stream; readers that started before may miss removed folders.  Returns the snapshot's batch
    (-1: there is no log, nothing was written).
    """
    base = state_dir.rstrip("/")
    log, shots = _folders(spark, base), _folders(spark, base + "_snapshot")
    upto = max(log, default=-1)
    if upto <= max(shots, default=-1):
        return max(shots, default=-1)
    current_metadata(spark, base).write.mode("overwrite").parquet(f"{base}_snapshot/batch_id={upto}")
    for path in [*(p for n, p in log.items() if n <= upto), *shots.values()]:
        _remove(spark, path)
    return upto


def tracked_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state store after the last batch: ``(repo_id, path, seq, sha1)``, one row per known path (deleted: no SHA-1)."""
    rows = spark.read.format("statestore").load(checkpoint)
    return rows.select("key.repo_id", "key.path", F.col("value.groupState.seq").alias("seq"), F.col("value.groupState.sha1").alias("sha1"))


def _frame(key: tuple, content: str | None = None, seq: int | None = None, sha1: str | None = None,
           change: str | None = None) -> pd.DataFrame:
    """One event, followed by a row without ``change`` per ``FRAME_BYTES / FRAME_ROWS`` characters of its content.

    The worker holds results, states included, until ``FRAME_ROWS`` result rows are there.  The extra rows make it send long
    contents earlier, and a path without an event gives a row too, so that its state is not held to the end of the task.
    """
    n = len(content or "") // (FRAME_BYTES // FRAME_ROWS)
    return pd.DataFrame({"repo_id": [key[0]] * (n + 1), "path": [key[1]] * (n + 1), "content": [content, *[None] * n],
                         "seq": pd.array([seq, *[None] * n], dtype="Int64"), "sha1": [sha1, *[None] * n], "change": [change, *[None] * n]})


def _track(expire_deleted_ms: int | None):
    """The stateful step for one path: frames of its dropped versions against ``(seq, sha1)``; rows of no event have no ``change``."""
    def track(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield _frame(key)
            return
        newest = None
        for frame in frames:  # versions come in bounded frames; only the newest is held
            for content, seq, sha1 in zip(frame["content"], frame["seq"], frame["sha1"], strict=True):
                row = (None if pd.isna(seq) else int(seq), None if pd.isna(content) else content, None if pd.isna(sha1) else sha1)
                rank = (row[0] is not None, row[0] or 0, row[1] is not None, row[1] or "")
                if newest is None or rank > newest[0]:
                    newest = (rank, row)
        if newest is None:
            return
        seq, content, sha1 = newest[1]
        known = state.exists
        old_seq, old_sha1 = state.get if known else (None, None)
        late = seq is not None and old_seq is not None and seq < old_seq
        if late or (content is None and old_sha1 is None):
            if known and old_sha1 is None and expire_deleted_ms is not None:
                state.setTimeoutDuration(expire_deleted_ms)  # a timer lasts until the key's next call only
            yield _frame(key)
            return
        if content is None:
            change = "deleted"
        elif old_sha1 is None:
            change = "new"
        else:
            change = "unchanged" if sha1 == old_sha1 else "changed"
        state.update((seq if seq is not None else old_seq, sha1))
        if change == "deleted" and expire_deleted_ms is not None:
            state.setTimeoutDuration(expire_deleted_ms)
        yield _frame(key, content, seq, sha1, change)

    return track


def file_events(drops: DataFrame, expire_deleted_ms: int | None = None) -> DataFrame:
    """What a stream of dropped files means for each path: ``EVENT_SCHEMA`` rows, at most one per path and batch."""
    timeout = GroupStateTimeout.NoTimeout if expire_deleted_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return drops.withColumn("sha1", F.sha1("content")).groupBy("repo_id", "path").applyInPandasWithState(
        _track(expire_deleted_ms), EVENT_SCHEMA, FILE_STATE, "append", timeout).filter(F.col("change").isNotNull())


def process_batch(events: DataFrame, batch_id: int, state_dir: str, provider=None,
                  responses: DataFrame | None = None) -> None:
    """One micro-batch of G4 (without selection) over ``file_events``: summaries for new and changed files, rows to the log.

    The events are written once before use: reading them twice would run the stateful step twice.
    """
    spark = events.sparkSession
    base = state_dir.rstrip("/")
    versions = {n: p for n, p in _folders(spark, base + "_pending").items() if n < batch_id}
    pending = spark.read.schema(PENDING_SCHEMA).parquet(versions[max(versions)]) if versions else None
    if pending is not None:
        events = events.join(pending.withColumn("_pending", F.lit(True)), ["repo_id", "path", "sha1"], "left")
        events = events.withColumn("change", F.when((F.col("change") == "unchanged") & F.col("_pending"), F.lit("changed"))
                                   .otherwise(F.col("change"))).drop("_pending")
    work = f"{base}_work/batch_id={batch_id}"
    events.filter(F.col("change") != "unchanged").write.mode("overwrite").parquet(work)
    events = spark.read.schema(EVENT_SCHEMA).parquet(work)
    need = profile(events.filter(F.col("change") != "deleted")).drop("content")
    answered = model.complete(summary_requests(need), provider=provider, responses=responses)
    rows = parse_summary(answered).select(
        "repo_id", "path", F.lit("file").alias("kind"), "language", F.lit("").alias("side"), "loc", "imports",
        "description", "sha1", "token_estimate", "change", "summary_status",
    )
    gone = events.filter(F.col("change") == "deleted")
    gone = gone.select(*[F.col(f.name) if f.name in ("repo_id", "path", "change") else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in LOG_SCHEMA.fields])
    # batch_id comes from the folder name (partition column), not from the files
    log = f"{base}/batch_id={batch_id}"
    rows.unionByName(gone).write.mode("overwrite").parquet(log)

    done = spark.read.schema(LOG_SCHEMA).parquet(log)
    failed = done.filter((F.col("change") != "deleted") & F.col("description").isNull()).select(*PENDING_SCHEMA.names)
    if pending is not None or not failed.isEmpty():
        kept = failed if pending is None else pending.join(done.select("repo_id", "path"), ["repo_id", "path"], "left_anti").unionByName(failed)
        kept.write.mode("overwrite").parquet(f"{base}_pending/batch_id={batch_id}")
        for n in sorted(versions)[:-1]:  # the newest earlier version stays for a replay of this batch
            _remove(spark, versions[n])
    _remove(spark, work)


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` whose state lives in RocksDB (on disk, not in executor memory) and whose Arrow batches are small."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    rows = int(own.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(min(rows, FRAME_ROWS) if rows > 0 else FRAME_ROWS))
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(FRAME_BYTES))
    return own


def incremental_metadata(spark: SparkSession, drop_dir: str, state_dir: str, checkpoint: str,
                         provider=None, responses: DataFrame | None = None,
                         available_now: bool = True, max_files_per_trigger: int | None = None,
                         expire_deleted_ms: int | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops.

    ``expire_deleted_ms``: forget deleted paths after this time (default: remember them).  Timers fire with the next batch.  It must stay
    set or unset for the life of a checkpoint.
    """
    own = _stream_session(spark)
    if available_now:  # timers would otherwise ask for another batch for ever
        own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    reader = own.readStream.schema(DROP_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (
        file_events(reader.parquet(drop_dir), expire_deleted_ms).writeStream.foreachBatch(
            lambda df, epoch: process_batch(df, epoch, state_dir, provider=provider, responses=responses))
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
