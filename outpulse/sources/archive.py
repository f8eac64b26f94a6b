"""Monthly archive tables: read, write, create, update, CSV import and export."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpulse.functions import dates as D
from outpulse.operators.keyed import append_new
from outpulse.schemas import ARCHIVES
from outpulse.session import store


def table_path(root: str, kind: str) -> str:
    return f"{root.rstrip('/')}/{kind}"


def _table(spark: SparkSession, root: str, kind: str) -> DataFrame | None:
    try:
        return spark.read.schema(ARCHIVES[kind].schema).parquet(table_path(root, kind))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_archive(spark: SparkSession, root: str, kind: str, months: Sequence[str] | None = None) -> DataFrame:
    """Archive rows of the given months (all without a list).

    Months prune partitions; a missing month adds nothing, and a missing
    archive is an empty table of the declared schema.
    """
    df = _table(spark, root, kind)
    if df is None:
        df = spark.createDataFrame([], ARCHIVES[kind].schema)
    return df if months is None else df.where(F.col("archive_month").isin(list(months)))


def write_archive(df: DataFrame, root: str, kind: str, as_of: Column | date) -> None:
    """Append rows, filed under the month of the run (not of the row)."""
    spec = ARCHIVES[kind]
    run = as_of if isinstance(as_of, Column) else F.lit(as_of)
    rows = df.select("repo", *spec.fields, D.archive_month(run).alias("archive_month"))
    # Rebalancing evens out hot months and merges small ones; the date order
    # inside each file gives row groups narrow date ranges to prune by.
    spread = rows.hint("rebalance", "archive_month").sortWithinPartitions("archive_month", "repo", spec.date)
    spread.write.mode("append").partitionBy("archive_month").parquet(table_path(root, kind))


def ensure_archive(spark: SparkSession, root: str, kind: str) -> bool:
    """Create an empty archive if there is none; an existing one is left alone."""
    if _table(spark, root, kind) is not None:
        return False
    empty = spark.createDataFrame([], ARCHIVES[kind].schema)
    empty.write.mode("append").partitionBy("archive_month").parquet(table_path(root, kind))
    return True


def update_archive(
    spark: SparkSession,
    root: str,
    kind: str,
    incoming: DataFrame,
    as_of: date,
    order_by: Sequence[str | Column] = ("_seq",),
    scope: str = "all",
) -> int:
    """Append the incoming rows the archive lacks and return how many were added.

    ``scope='all'`` looks for known keys in every month, ``'archive_month'``
    in the month of the run only, which files late days again after a month's
    end. Repeating a run adds nothing, so a failed run can simply be repeated.
    The incoming rows are made once, and only the added ones are counted.
    """
    fresh = new_rows(spark, root, kind, store(incoming, "incoming"), as_of, order_by, scope)
    if fresh is None:
        ensure_archive(spark, root, kind)
        return 0
    # Counted from the file footers of the written rows: an observed metric is lost where
    # an adaptive plan finds nothing to add, and may count a retried task twice.
    fresh = store(fresh, "added")
    write_archive(fresh, root, kind, as_of)
    ensure_archive(spark, root, kind)
    return fresh.count()


def new_rows(
    spark: SparkSession, root: str, kind: str, incoming: DataFrame, as_of: date,
    order_by: Sequence[str | Column] = ("_seq",), scope: str = "all",
) -> DataFrame | None:
    """The incoming rows that the archive lacks, first one per key; None if nothing came in."""
    spec = ARCHIVES[kind]
    existing = read_archive(spark, root, kind, [as_of.strftime("%Y_%m")] if scope == "archive_month" else None)
    # Keys hold the date, so only the incoming date span can match: the
    # literals reach the scan as row-group filters.
    lo, hi, undated, rows = incoming.agg(
        F.min(spec.date), F.max(spec.date), F.count_if(F.col(spec.date).isNull()), F.count("*")
    ).first()
    if not rows:
        return None
    span = F.col(spec.date).between(F.lit(lo), F.lit(hi)) if lo is not None else F.lit(False)
    existing = existing.where(span | F.col(spec.date).isNull() if undated else span)
    return append_new(existing, incoming, spec.all_keys, order_by)


_BATCHES = "stream STRING, batch_id BIGINT, added BIGINT"


def finished_batches(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """(stream, batch_id, added) of every micro-batch that is wholly in the archive."""
    path = f"{table_path(root, kind)}-batches"
    try:
        return spark.read.schema(_BATCHES).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _BATCHES)


def append_batch(
    spark: SparkSession, root: str, kind: str, incoming: DataFrame, as_of: date, stream: str, batch_id: int,
    order_by: Sequence[str | Column] = ("_seq",),
) -> int:
    """:func:`update_archive` for a micro-batch that may come again; a replay returns the first count.

    The new rows are written beside the archive first. A replay of a batch
    that ended before its entry in the table of finished batches goes on from
    those rows, adds the ones the archive still lacks and files their first count.
    """
    done = finished_batches(spark, root, kind).where((F.col("stream") == stream) & (F.col("batch_id") == batch_id))
    first = done.agg(F.min("added")).first()[0]
    if first is not None:
        return first
    path = f"{table_path(root, kind)}-staged/{hashlib.md5(stream.encode()).hexdigest()}-{batch_id}"
    staged = _staged(spark, path)
    if staged is None:
        fresh = new_rows(spark, root, kind, store(incoming, "incoming"), as_of, order_by)
        if fresh is not None:
            fresh.write.mode("overwrite").parquet(path)
            staged = _staged(spark, path)
    added = 0
    if staged is not None:
        added = staged.count()
        missing = new_rows(spark, root, kind, staged, as_of, order_by)
        if missing is not None:
            write_archive(missing, root, kind, as_of)
    spark.createDataFrame([(stream, batch_id, added)], _BATCHES).coalesce(1).write.mode("append").parquet(f"{table_path(root, kind)}-batches")
    return added


def _staged(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of a write that ended; an interrupted one has no files to read a schema from."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def export_csv(df: DataFrame, path: str, kind: str) -> None:
    """CSV files with a header, quoted only where needed."""
    rows = df.select("repo", *ARCHIVES[kind].fields)
    rows.write.mode("append").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def import_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows of CSV files with the declared schema; nothing is inferred."""
    spec = ARCHIVES[kind]
    schema = spec.schema.fields[:-1]
    reader = spark.read.schema(type(spec.schema)(schema)).option("header", True).option("escape", '"')
    return reader.csv(path)


def import_csv_checked(spark: SparkSession, path: str, kind: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Typed rows of CSV files, and the lines that are none: (rows, rejects).

    A line is rejected if it has fewer or more fields than the dataset, or a
    value that its type cannot hold. ``rejects`` has the ``file`` and the
    ``line`` as it stood. Rows and rejects add up to the lines read, headers
    apart. The lines are parsed once, and both tables are stored.
    """
    spec = ARCHIVES[kind]
    fields = spec.schema.fields[:-1]
    schema = type(spec.schema)([*fields, T.StructField("_bad", T.StringType())])
    reader = spark.read.schema(schema).option("header", header).option("escape", '"').option("mode", "PERMISSIVE")
    lines = reader.option("columnNameOfCorruptRecord", "_bad").csv(path).withColumn("file", F.input_file_name())
    parsed = store(lines, "csv-lines")
    rows = parsed.where("_bad IS NULL").drop("_bad", "file")
    return rows, parsed.where("_bad IS NOT NULL").select("file", F.col("_bad").alias("line"))
