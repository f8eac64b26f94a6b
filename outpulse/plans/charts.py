"""Chart tables over the archive: the data behind the four traffic charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outpulse.functions import text as X
from outpulse.operators import traffic as TR


def in_months(archive: DataFrame, months: Sequence[str] | None) -> DataFrame:
    """Rows filed in the given months."""
    return archive if months is None else archive.where(F.col("archive_month").isin(list(months)))


def views_clones(views: DataFrame, clones: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Daily views and clones on one axis, ascending."""
    daily = [TR.one_per_date(in_months(df, months), kind) for df, kind in ((views, "views"), (clones, "clones"))]
    return TR.align_daily(*daily).orderBy("repo", "date")


def repo_stats(stats: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Stars and forks per date, ascending."""
    daily = TR.one_per_date(in_months(stats, months), "repo_stats")
    return daily.select("repo", "date", "stars", "forks").orderBy("repo", "date")


def referrers(archive: DataFrame, months: Sequence[str] | None = None, n: int = 10) -> DataFrame:
    """Top referrers per repository over the months."""
    sums = TR.sum_by(TR.distinct_rows(in_months(archive, months), "referrers"), "referrer")
    return TR.top_keys_per(sums, "referrer", n=n)


def paths(archive: DataFrame, months: Sequence[str] | None = None, n: int = 10) -> DataFrame:
    """Top paths per repository over the months; long paths get a label, the path stays the key."""
    sums = TR.sum_by(TR.distinct_rows(in_months(archive, months), "paths"), "path")
    return TR.top_keys_per(sums, "path", n=n).withColumn("label", X.label_tail(F.col("path")))
