"""Session settings and the shared working folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "outpulse", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="outpulse-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session of one process may fall back to a temporary folder: on a
    cluster, a pretended one included, a machine-local path is not shared.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if path:
        return path.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
    return _local_dir(spark.sparkContext.applicationId)


def run_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path for one run's tables below the shared folder."""
    return f"{shared_dir(spark)}/outpulse/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Rows written once as a table in the shared folder, for plans that read them several times.

    Readers prune its columns, know its size and survive the loss of any
    executor.
    """
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, which also fixes the partitions and their order."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def require_utc(spark: SparkSession) -> None:
    """Streams need TIMESTAMP event times, whose days are cut in the session zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "Etc/GMT", "+00:00"):
        raise ValueError(f"session time zone must be UTC, not {zone}")
