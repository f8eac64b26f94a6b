"""Repository traffic: daily series, rankings, totals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpulse.functions import dates as D
from outpulse.operators.keyed import first_per_key, top_n_per
from outpulse.schemas import ARCHIVES


def distinct_rows(archive: DataFrame, kind: str) -> DataFrame:
    """Union of the months without identical rows; the archive month does not count."""
    return archive.select("repo", *ARCHIVES[kind].fields).distinct()


def one_per_date(
    archive: DataFrame, kind: str, order_by: Sequence[str | Column] = ("archive_month",)
) -> DataFrame:
    """One row per repository and date: the one filed first."""
    spec = ARCHIVES[kind]
    rest = [c for c in spec.fields if c != spec.date]
    picked = first_per_key(archive, ["repo", spec.date], [*order_by, *rest])
    return picked.select("repo", *spec.fields)


def daily_traffic(events: DataFrame, by: Sequence[str], ts: str = "ts", user: str = "user_id") -> DataFrame:
    """Events to daily ``count`` and ``uniques``.

    Rows are first folded to one per day and user, so neither a busy day nor a
    busy user ends up in one task.
    """
    per_user = events.groupBy(*by, F.col(ts).cast("date").alias("date"), user).agg(F.count("*").alias("n"))
    return per_user.groupBy(*by, "date").agg(
        F.sum("n").alias("count"), F.count(user).alias("uniques")
    )


def trailing_totals(
    events: DataFrame, by: Sequence[str], as_of: date, days: int = 14, ts: str = "ts", user: str = "user_id"
) -> DataFrame:
    """Count and uniques of the ``days`` before ``as_of``, from events: daily uniques do not add up."""
    start = F.date_sub(F.lit(as_of), days).cast("timestamp_ntz")
    end = F.lit(as_of).cast("timestamp_ntz")
    per_user = (
        events.where((F.col(ts) >= start) & (F.col(ts) < end)).groupBy(*by, user).agg(F.count("*").alias("n"))
    )
    return per_user.groupBy(*by).agg(F.sum("n").alias("count"), F.count(user).alias("uniques"))


def daily_sketches(events: DataFrame, by: Sequence[str], ts: str = "ts", user: str = "user_id", log_k: int = 12) -> DataFrame:
    """Count and a mergeable HyperLogLog sketch of the users per day: a few KB each, however many users.

    Days are sketched once and stored; any window is then a union of them.
    """
    day = F.col(ts).cast("date").alias("date")
    return events.groupBy(*by, day).agg(F.count("*").alias("count"), F.hll_sketch_agg(user, log_k).alias("users"))


def trailing_from_sketches(sketches: DataFrame, by: Sequence[str], as_of: date, days: int = 14) -> DataFrame:
    """:func:`trailing_totals` from stored daily sketches; ``uniques`` is an estimate, 3% off at most in 19 of 20 cases."""
    start = F.date_sub(F.lit(as_of), days)
    window = sketches.where((F.col("date") >= start) & (F.col("date") < F.lit(as_of)))
    union = F.hll_sketch_estimate(F.hll_union_agg("users")).alias("uniques")
    return window.groupBy(*by).agg(F.sum("count").alias("count"), union)


def ascending(series: DataFrame, by: Sequence[str] = ("repo",)) -> DataFrame:
    """A daily series by date, then by series."""
    return series.orderBy("date", *by)


def sum_by(archive: DataFrame, key: str, measure: str = "views", by: Sequence[str] = ("repo",)) -> DataFrame:
    """Sum of a measure per key; rows without a key do not count."""
    return archive.where(F.col(key).isNotNull()).groupBy(*by, key).agg(F.sum(measure).alias(measure))


def top_keys(sums: DataFrame, key: str, measure: str = "views", n: int = 10) -> DataFrame:
    """Top ``n`` over everything; equal sums fall back to the key."""
    return sums.orderBy(F.desc(measure), key).limit(n)


def top_keys_per(
    sums: DataFrame, key: str, measure: str = "views", n: int = 10, by: Sequence[str] = ("repo",)
) -> DataFrame:
    """Top ``n`` per repository; equal sums fall back to the key."""
    return top_n_per(sums, by, [F.desc(measure), key], n)


def align_daily(views: DataFrame, clones: DataFrame) -> DataFrame:
    """Views and clones on one time axis; a day known to one side only stays."""
    return views.join(clones, ["repo", "date"], "full_outer").select(
        "repo", "date", "views", "unique_visitors", "clones", "unique_cloners"
    )


def added_counts(added: dict[str, DataFrame]) -> DataFrame:
    """Number of added rows per dataset and repository."""
    parts = [df.select(F.lit(kind).alias("kind"), "repo") for kind, df in added.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("kind", "repo").agg(F.count("*").alias("added"))


def archive_links(as_of: Column, base: str) -> Column:
    """Link line to the month's archives of every dataset."""
    month = D.archive_month(as_of)
    labels = {kind: kind.replace("_", " ") for kind in ARCHIVES}
    links = [
        F.concat(F.lit(f"<{base}/{kind}/{kind}_"), month, F.lit(f".csv|{label}>")) for kind, label in labels.items()
    ]
    return F.concat_ws(" · ", *links)
