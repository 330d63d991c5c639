"""Model calls as table operators.

A request is a row; a response is a row keyed by ``request_id`` (SHA-1 of the
operation, parameters and messages).  ``complete`` replays stored responses by
a join and sends only the remaining requests to a user ``provider`` through
``mapInPandas``.  Answers go to a journal as the provider yields them (see ``Journal``), so a task that dies midway
or a run that is started again asks only for what was not answered yet; requests whose answer had not been yielded
are asked again.  The provider's output is checkpointed before use.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codesift.plans import prompts as P
from codesift.session import materialize, scratch_path

MESSAGE_TYPE = T.ArrayType(T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
]))

PARAMS_TYPE = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("max_tokens", T.IntegerType()),
    T.StructField("max_completion_tokens", T.IntegerType()),
    T.StructField("reasoning_effort", T.StringType()),
    T.StructField("stream", T.BooleanType()),
    T.StructField("response_format", T.StructType([T.StructField("type", T.StringType())])),
])

RESPONSE_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType(), False),
    T.StructField("content", T.StringType()),
    T.StructField("status", T.StringType()),
])

Provider = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def messages(system: Column, user: Column) -> Column:
    """``[{role: system, content}, {role: user, content}]``."""
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def params(model: str | Column = P.DEFAULT_MODEL, temperature: float | None = None,
           max_tokens: int | None = None, response_format: str | None = None,
           reasoning_effort: str | None = None) -> Column:
    """M2: call parameters; completion-token models get ``max_completion_tokens`` and ``stream``
    and no temperature, the others ``temperature`` / ``max_tokens``.  Unset values stay null
    and are dropped from the JSON form (T11)."""
    m = F.lit(model) if isinstance(model, str) else model
    special = m.isin(*P.COMPLETION_TOKEN_MODELS)
    null_int = F.lit(None).cast("int")
    return F.struct(
        m.alias("model"),
        F.when(~special, F.lit(temperature).cast("double")).alias("temperature"),
        F.when(~special, F.lit(max_tokens).cast("int")).otherwise(null_int).alias("max_tokens"),
        F.when(special, F.lit(max_tokens).cast("int")).otherwise(null_int).alias("max_completion_tokens"),
        F.when(special, F.lit(reasoning_effort).cast("string")).alias("reasoning_effort"),
        F.when(special, F.lit(False)).alias("stream"),
        F.when(F.lit(response_format is not None), F.struct(F.lit(response_format).cast("string").alias("type")))
        .alias("response_format"),
    ).cast(PARAMS_TYPE)


def request_id(operation: Column, msgs: Column, prm: Column) -> Column:
    """J8 key: hash of everything that determines the answer."""
    return F.sha1(F.concat_ws("\u0001", operation, F.to_json(prm), F.to_json(msgs)))


def with_request(df: DataFrame, operation: Column | str, system: Column, user: Column, prm: Column) -> DataFrame:
    """Adds ``operation, messages, params, params_json, request_id`` to ``df``."""
    op = F.lit(operation) if isinstance(operation, str) else operation
    msgs = messages(system, user)
    return (
        df.withColumn("operation", op)
        .withColumn("messages", msgs)
        .withColumn("params", prm)
        .withColumn("params_json", F.to_json(F.col("params")))
        .withColumn("request_id", request_id(F.col("operation"), F.col("messages"), F.col("params")))
    )


def usable() -> Column:
    """A stored answer that needs no retry: it has content and its status is 'ok' (or unset)."""
    return F.col("content").isNotNull() & (F.coalesce(F.col("status"), F.lit("ok")) == "ok")


def _timed(responses: DataFrame) -> DataFrame:
    at = F.col("answered_at").cast("timestamp") if "answered_at" in responses.columns else F.lit(None).cast("timestamp")
    return responses.select("request_id", "content", "status", at.alias("answered_at"))


def replay(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """M1 offline: stored answers joined to requests; unanswered requests get status 'missing'.

    ``responses`` may hold several rows per request id (re-runs).  A usable answer (see ``usable``)
    goes before an unusable one, then the latest by ``answered_at`` (when given) counts; content and status
    come from the same row.
    """
    rows = _timed(responses)
    best = F.struct(usable().alias("usable"), "answered_at", "content", F.coalesce("status", F.lit("ok")).alias("status"))
    resp = rows.groupBy("request_id").agg(F.max(best).alias("_best")).select("request_id", "_best.content", "_best.status")
    return requests.join(resp, "request_id", "left").withColumn(
        "status", F.coalesce(F.col("status"), F.lit("missing"))
    )


JOURNAL_SCHEMA = T.StructType([*RESPONSE_SCHEMA.fields, T.StructField("attempt", T.IntegerType()),
                               T.StructField("answered_at", T.TimestampType())])
_JOURNAL_ARROW = pa.schema([("request_id", pa.string()), ("content", pa.string()), ("status", pa.string()),
                            ("attempt", pa.int32()), ("answered_at", pa.timestamp("us", tz="UTC"))])


class Journal:
    """Answers on shared storage, written while the tasks that ask for them still run.

    Every batch that a provider yields becomes one small Parquet file ``run=<id>/part=<task>/<attempt>-<n>.parquet``,
    complete from the moment it has this name.  A retried task reads the files of its earlier attempts and asks only for
    the rest; a later run reads the whole folder and joins it away (``answers``).  The folder must be one that all
    executors reach and that pyarrow can open (a local or mounted path, ``hdfs://``, ``s3://``, ``gs://``).  A task that
    Spark runs twice at the same time (speculation) may still ask twice.
    """

    def __init__(self, path: str):
        self.path = re.sub(r"^file:/+", "/", path).rstrip("/")
        self.run = uuid.uuid4().hex

    def _open(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.path:
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def answers(self, spark: SparkSession) -> DataFrame:
        """All answers of earlier runs and attempts."""
        store, root = self._open()
        store.create_dir(root, recursive=True)
        if not [x for x in store.get_file_info(fs.FileSelector(root)) if x.base_name.startswith("run=")]:
            return spark.createDataFrame([], JOURNAL_SCHEMA)
        return spark.read.schema(JOURNAL_SCHEMA).option("recursiveFileLookup", "true").parquet(self.path)

    def ask(self, provider: Provider) -> Provider:
        """``provider`` with every answer journaled, and without the requests that an earlier attempt has answered."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            context = TaskContext.get()
            store, root = self._open()
            folder = f"{root}/run={self.run}/part={context.partitionId()}"
            store.create_dir(folder, recursive=True)
            files = [x.path for x in store.get_file_info(fs.FileSelector(folder)) if x.base_name.endswith(".parquet")
                     and not x.base_name.startswith("_")]
            told = [pq.read_table(store.open_input_file(x), schema=_JOURNAL_ARROW).to_pandas()[RESPONSE_SCHEMA.names] for x in files]
            yield from told
            done = {i for t in told for i in t["request_id"]}
            left = (b[~b["request_id"].isin(done)] for b in batches)
            for n, out in enumerate(provider(b for b in left if len(b))):
                out = out[RESPONSE_SCHEMA.names]
                rows = out.assign(attempt=context.attemptNumber(), answered_at=datetime.now(timezone.utc))
                name = f"{context.attemptNumber()}-{n}.parquet"
                pq.write_table(pa.Table.from_pandas(rows, schema=_JOURNAL_ARROW, preserve_index=False), f"{folder}/_{name}", filesystem=store)
                store.move(f"{folder}/_{name}", f"{folder}/{name}")
                yield out

        return run


def complete(requests: DataFrame, provider: Provider | None = None, responses: DataFrame | None = None,
             partitions: int | None = None, journal: str | None = None,
             messages_of: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """M1: answers for ``requests``.

    Usable stored ``responses`` are reused (no call); the rest, failed answers included, go to ``provider`` (an
    ``Iterator[pandas.DataFrame] -> Iterator[pandas.DataFrame]`` mapping columns
    ``request_id, operation, messages_json, params_json`` to ``request_id, content, status``),
    spread over ``partitions`` tasks, journaled as they arrive and checkpointed before use.  ``journal`` is the folder of
    the journal; name one to let a run that is started again use what an earlier one was answered (default: a
    folder of this call alone under the checkpoint folder).  Requests may come without ``messages`` (large ones): ``messages_of``
    then adds them to the rows that need an answer, one row per request id.
    """
    spark = requests.sparkSession
    stored = _timed(responses if responses is not None else spark.createDataFrame([], RESPONSE_SCHEMA))
    if provider is None:
        return replay(requests, stored if journal is None else stored.unionByName(_timed(Journal(journal).answers(spark))))
    book = Journal(journal or scratch_path(spark, f"journal-{uuid.uuid4().hex}"))
    stored = stored.unionByName(_timed(materialize(book.answers(spark))))
    todo = requests.join(stored.filter(usable()).select("request_id"), "request_id", "left_anti").dropDuplicates(["request_id"])
    if messages_of is not None:
        todo = messages_of(todo)
    todo = todo.select("request_id", "operation", F.to_json("messages").alias("messages_json"), "params_json")
    n = partitions or spark.sparkContext.defaultParallelism
    # the order of a partition's requests is fixed, so that a retried task meets the same batches
    todo = todo.repartition(n, "request_id").sortWithinPartitions("request_id")
    fresh = materialize(todo.mapInPandas(book.ask(provider), RESPONSE_SCHEMA))
    fresh = fresh.withColumn("answered_at", F.current_timestamp())
    return replay(requests, stored.unionByName(_timed(fresh)))


def call_stats(answered: DataFrame) -> DataFrame:
    """M3: per operation, number of requests, prompt characters, answer characters, missing answers."""
    prompt_chars = F.aggregate(F.col("messages"), F.lit(0).cast("bigint"),
                               lambda acc, m: acc + F.coalesce(F.length(m["content"]), F.lit(0)))
    return answered.groupBy("operation").agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.sum(prompt_chars).alias("prompt_chars"),
        F.sum(F.coalesce(F.length("content"), F.lit(0))).cast("bigint").alias("answer_chars"),
        F.count_if(F.col("status") == "missing").alias("n_missing"),
    )
