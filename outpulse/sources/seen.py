"""Store of URLs that were already reported."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpulse.schemas import SEEN

BUCKETS = 256


def _schema(by: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in by] + SEEN.fields)


def read_seen(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """The store's rows; an absent store is empty."""
    try:
        return spark.read.schema(_schema(by)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _schema(by))


def seen_rows(results: DataFrame, as_of: Column | date, by: Sequence[str] = ()) -> DataFrame:
    """Store rows of qualified results, stamped with the run date."""
    stamp = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return results.select(*by, "url", "title", stamp.cast("date").alias("date_seen"))


def append_seen(results: DataFrame, path: str, as_of: Column | date, by: Sequence[str] = ()) -> None:
    """Remember the qualified results."""
    seen_rows(results, as_of, by).write.mode("append").parquet(path)


def in_buckets(rows: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """Rows with the ``bucket`` of their keys."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, like: DataFrame) -> DataFrame:
    """Rows of the partitions that the buckets of ``like`` name: at most as many numbers as there are buckets.

    The others are left out of the scan. An absent table is empty.
    """
    wanted = [r.bucket for r in like.select("bucket").distinct().limit(BUCKETS).collect()]
    full = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    try:
        return spark.read.schema(full).parquet(path).where(F.col("bucket").isin(wanted)).drop("bucket")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_bucketed(rows: DataFrame, path: str) -> None:
    """Adds rows of a seen store (see :func:`seen_rows`), filed by a hash of their URL."""
    in_buckets(rows).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(path)


def read_bucketed(spark: SparkSession, path: str, like: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Such a store's rows; with ``like``, of the partitions that its URLs fall into."""
    if like is not None:
        return read_buckets(spark, path, _schema(by), in_buckets(like.select("url")))
    try:
        return spark.read.schema(T.StructType([*_schema(by).fields, T.StructField("bucket", T.IntegerType())])).parquet(path).drop("bucket")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _schema(by))
