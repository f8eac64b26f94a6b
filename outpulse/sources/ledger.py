"""Runs filed under an id, whose rows count only once the run's marker is written.

A run writes its tables below ``<root>/<table>/attempt=<id>`` and then one
marker row. Rows without a marker are those of a run that died; nobody reads
them, and the run is simply made again under the same number and a new id.
There is one writer per ledger.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MARKERS = "run_no BIGINT, attempt STRING, as_of DATE"


@dataclass(frozen=True)
class Run:
    """One attempt at the run ``run_no``."""

    root: str
    run_no: int
    attempt: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}/attempt={self.attempt}"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def markers(spark: SparkSession, root: str) -> DataFrame:
    """One row per finished run."""
    return _read(spark, f"{root}/markers", T.StructType.fromDDL(_MARKERS))


def begin(spark: SparkSession, root: str) -> Run:
    """The run after the last finished one; runs count from 0."""
    last = markers(spark, root).agg(F.max("run_no")).first()[0]
    return Run(root, 0 if last is None else last + 1, uuid.uuid4().hex)


def file_rows(run: Run, table: str, rows: DataFrame) -> DataFrame:
    """Writes rows of the run and returns them as written, so that they are made once."""
    rows.write.parquet(run.path(table))
    return rows.sparkSession.read.schema(rows.schema).parquet(run.path(table))


def finish(spark: SparkSession, run: Run, as_of: date) -> None:
    """Writes the marker; from then on the run's rows count."""
    spark.createDataFrame([(run.run_no, run.attempt, as_of)], _MARKERS).coalesce(1).write.mode("append").parquet(f"{run.root}/markers")


def finished(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """Rows of all finished runs with their ``run_no``; attempts without a marker are pruned, not read."""
    stored = _read(spark, f"{root}/{table}", T.StructType([*schema.fields, T.StructField("attempt", T.StringType())]))
    return stored.join(markers(spark, root).select("attempt", "run_no"), "attempt").drop("attempt")


def latest(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """Rows of the last finished run."""
    last = markers(spark, root).agg(F.max_by("attempt", "run_no")).first()[0]
    path = f"{root}/{table}/attempt={last}" if last else f"{root}/none"
    return _read(spark, path, schema)
