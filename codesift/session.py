"""Session helpers: a local session for tests/bench, and lineage cutting.

On a cluster the session is created by the platform; only ``materialize``
is used there, and it reads ``spark.checkpoint.dir`` from the session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "codesift") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Only a local session (tests, bench) without one gets a private folder; on a cluster a
    folder that other machines cannot see would lose data, so this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="codesift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: The session setting by which a query's shuffle files go when it ends, instead of when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, settings: dict[str, str] | None = None) -> DataFrame:
    """``df`` as a columnar table under the shared checkpoint folder, read back.

    Unlike a checkpoint, later steps read only the columns they use.  The folder is cleared with the checkpoint folder.
    Nothing reads the shuffle files behind a written table again, so they are removed at once.  ``settings`` of the session
    hold for the query that writes it.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    conf = df.sparkSession.conf
    settings = {SHUFFLE_CLEANUP: "true"} | (settings or {})
    before = {k: conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            conf.set(k, v)
        df.write.parquet(path, compression="zstd")
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` dealt by ``cols`` to as many tasks as a shuffle has, before costly work on rows that may come from one
    file split.  The explicit number keeps adaptive execution from merging small partitions again."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)
