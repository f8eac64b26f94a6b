"""First hit of every user, kept as a table that grows by the days since its last update."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outpulse.operators.web import USER, first_hits, in_range

_SCHEMA = "property_id STRING, user_id BIGINT, first_ts TIMESTAMP_NTZ, through DATE"


def _filed(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCHEMA)


def read_firsts(spark: SparkSession, path: str) -> DataFrame:
    """(property_id, user_id, first_ts), the unknown user of a property included; an absent table is empty."""
    return _filed(spark, path).drop("through")


def update_firsts(spark: SparkSession, path: str, hits: DataFrame, through: date, since: date = date(1970, 1, 1)) -> DataFrame:
    """Files the users first seen up to and on the day ``through`` and returns the table.

    Only hits after the last filed day (``since`` for a new table) are read; an
    update up to a day that is filed already reads and adds nothing. A hit
    that arrives after its day was filed does not change the table. There is
    one writer per table; an update that ended without its commit left nothing.
    """
    filed = _filed(spark, path)
    last = filed.agg(F.max("through")).first()[0]
    start = since if last is None else last + timedelta(days=1)
    if start <= through:
        found = first_hits(hits.where(in_range(F.col("ts"), start, through)))
        known = filed.select(*[F.col(c).alias(f"_{c}") for c in USER])
        same = F.col("property_id").eqNullSafe(F.col("_property_id")) & F.col("user_id").eqNullSafe(F.col("_user_id"))
        fresh = found if last is None else found.join(known, same, "left_anti")
        fresh.withColumn("through", F.lit(through)).write.mode("append").partitionBy("through").parquet(path)
    return read_firsts(spark, path)
