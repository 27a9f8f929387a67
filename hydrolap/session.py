"""Session, shared work folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows up to which a narrow, counted table may be broadcast.
BROADCAST_ROWS = 1_000_000


def build_session(app: str = "hydrolap", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session of our own (tests, bench). Jobs that get a session never change its settings."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="hydrolap-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, never reused between runs."""
    return f"{shared_dir(spark).rstrip('/')}/hydrolap/{name}-{uuid.uuid4().hex}"


def stable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so a lost executor cannot change row placement."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder, whatever file system it is in."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def work_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh shared folder that is removed at the end, also after a failure. Results must not read it lazily."""
    path = new_folder(spark, name)
    try:
        yield path
    finally:
        drop_folder(spark, path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of queries that have ended. It does so once the driver's collector finds their plans unused, which
    may take half an hour on a driver with little to do, and until then the files of every step lie side by side."""
    spark.sparkContext._jvm.System.gc()


def store(df: DataFrame, path: str) -> DataFrame:
    """Write rows to a folder and read them back: later passes do not compute them again, and a lost executor costs nothing."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``store`` in a fresh shared folder that stays."""
    return store(df, new_folder(df.sparkSession, name))


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a stored table that was counted; beyond the bound the join is left to AQE."""
    return F.broadcast(df) if df.count() <= rows else df
