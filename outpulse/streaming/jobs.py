"""Incremental jobs on Structured Streaming; every one can be repeated safely."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from outpulse.operators.keyed import unseen
from outpulse.session import require_utc, store
from outpulse.sources.archive import append_batch, ensure_archive
from outpulse.sources.seen import append_bucketed, in_buckets, read_bucketed, read_buckets, seen_rows

LOOK_BACK = "14 days"


def landing_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files: int | None = None, **options: str
) -> DataFrame:
    """Stream over a landing folder, ``files`` files per micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.load(path)


def run_archive_stream(
    landed: DataFrame,
    root: str,
    kind: str,
    as_of: date,
    checkpoint: str,
    parse: Callable[[DataFrame], DataFrame] = lambda df: df,
    order_by: Sequence[str] = ("_seq",),
) -> StreamingQuery:
    """Append what landed since the last run to the archive; known keys add nothing.

    A micro-batch is parsed once. One that is replayed after a failure writes
    no row twice and keeps the count of its first run in the archive's table
    of finished batches.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch.sparkSession, root, kind, parse(batch), as_of, checkpoint, batch_id, order_by)

    ensure_archive(landed.sparkSession, root, kind)
    return (
        landed.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_unseen_stream(
    landed: DataFrame,
    store: str,
    as_of: date,
    checkpoint: str,
    order_by: Sequence[str],
    select: Callable[[DataFrame], DataFrame] = lambda df: df,
    by: Sequence[str] = (),
) -> StreamingQuery:
    """Seen-URL state across runs: ``select`` keeps what a run reports, the store remembers it.

    The store is partitioned by a hash of the URL. A micro-batch reads the
    partitions its URLs fall into and no others.
    """

    def report(batch: DataFrame, batch_id: int) -> None:
        seen = read_bucketed(batch.sparkSession, store, batch, by)
        append_bucketed(seen_rows(select(unseen(batch, seen, order_by, by)), as_of, by), store)

    return (
        landed.writeStream.foreachBatch(report)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedupe_stream(events: DataFrame, keys: Sequence[str], ts: str = "ts", look_back: str = LOOK_BACK) -> DataFrame:
    """Stateful dedupe for feeds whose repeats stay within the look-back; what is older than it leaves the state.

    A key that returns after it left the state is emitted again;
    :func:`run_dedupe_stream` keeps those back.
    """
    require_utc(events.sparkSession)
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, look_back)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def run_dedupe_stream(
    events: DataFrame, keys: Sequence[str], path: str, checkpoint: str, ts: str = "ts", look_back: str = LOOK_BACK,
) -> StreamingQuery:
    """Every key once, for feeds without a bound on repeats: the look-back as state, the table for what is older.

    The state answers for keys of the look-back, which are nearly all, and is
    bounded by them. What passes it is new or has come back after its time; only
    those few are looked up in the table of keys that were emitted, in the partitions
    of their hash. A replayed micro-batch finds its keys there. A micro-batch adds
    at most one file to a partition, however many tasks it has. Keys are null-safe.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        known = [f"_{k}" for k in keys]
        found = store(in_buckets(batch.select(*keys), keys), "passed")
        emitted = read_buckets(batch.sparkSession, path, found.drop("bucket").schema, found).toDF(*known)
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        fresh = found.join(emitted, same, "left_anti").repartition("bucket")
        # The bucket follows from the keys; named with them, rows need not be dealt again.
        fresh.dropDuplicates([*keys, "bucket"]).write.mode("append").partitionBy("bucket").parquet(path)

    return (
        dedupe_stream(events, keys, ts, look_back).writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_stream(
    events: DataFrame, by: Sequence[str], ts: str = "ts", user: str = "user_id", late: str = "1 hour",
    closing: DataFrame | None = None,
) -> DataFrame:
    """Daily ``count`` and exact ``uniques``; a day is emitted once the watermark passed its end.

    The newest days of a feed that has ended stay open until a later row
    comes. ``closing`` is a stream of such rows without content, one column
    ``until``: the days that end ``late`` before it are emitted. Rows that come
    after their day was emitted are dropped; :func:`late_rows` counts them.

    Two chained aggregations (per day and user, then per day) keep the unique
    count exact and spread a busy day over its users.
    """
    require_utc(events.sparkSession)
    rows = events.select(*by, user, F.col(ts).cast("timestamp").alias(ts), F.lit(False).alias("_closing"))
    if closing is not None:
        marks = closing.select(F.col("until").cast("timestamp").alias(ts), F.lit(True).alias("_closing"))
        rows = rows.unionByName(marks, allowMissingColumns=True)
    # Written with the event time, the filter stays above the watermark, which must see the marks.
    timed = rows.withWatermark(ts, late).where(~F.col("_closing") | F.col(ts).isNull())
    per_user = timed.groupBy(F.window(ts, "1 day").alias("day"), *by, user).agg(F.count("*").alias("n"))
    per_day = per_user.groupBy(F.window(F.window_time("day"), "1 day").alias("day"), *by).agg(
        F.sum("n").alias("count"), F.count("*").alias("uniques")
    )
    return per_day.select(*by, F.col("day.start").cast("date").alias("date"), "count", "uniques")


def late_rows(query: StreamingQuery) -> int:
    """Rows the finished run dropped as late, by its progress reports."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's output to a parquet table, exactly once."""
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
