"""Date functions as Column expressions. Instants are UTC; no session time zone is read."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400
LABEL = "MMM dd, yyyy"


def iso_date(timestamp_text: Column) -> Column:
    """Date part of an ISO-8601 timestamp text; NULL if it holds none."""
    return F.substring(timestamp_text, 1, 10).try_cast("date")


def strict_date(text: Column) -> Column:
    """The day that an ISO-8601 date or timestamp names; NULL for any other text, one without a day included."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}(?:$|[T ])"), iso_date(text))


def epoch_date(seconds: Column) -> Column:
    """UTC date of an epoch-seconds value."""
    return F.date_add(F.lit(date(1970, 1, 1)), F.floor(seconds / DAY).cast("int"))


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a zone-less UTC timestamp."""
    days = F.datediff(ts.cast("date"), F.lit(date(1970, 1, 1))).cast("bigint")
    return days * DAY + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def archive_month(day: Column) -> Column:
    """Month part of an archive name."""
    return F.date_format(day, "yyyy_MM")


def archive_name(kind: str, day: Column) -> Column:
    """Archive name, e.g. ``views_2026_04``."""
    return F.concat(F.lit(kind + "_"), archive_month(day))


def last_months(as_of: Column, last: Column, months: list[str] | None = None) -> Column:
    """Ascending ``yyyy_MM`` names of the ``last`` months that end with the month of ``as_of``.

    Without a count (NULL or 0) the explicit ``months`` are taken, else the
    current month alone.
    """
    first = F.trunc(as_of, "MM")
    span = F.sequence(F.add_months(first, 1 - last), first, F.expr("interval 1 month"))
    names = F.transform(span, lambda d: archive_month(d))
    given = F.array(*[F.lit(m.replace("-", "_")) for m in months]) if months else F.array(archive_month(first))
    return (
        F.when(F.coalesce(last, F.lit(0)) == 0, given)
        .when(last > 0, names)
        .otherwise(F.array().cast("array<string>"))
    )


def resolve_months(as_of: date, last: int | None = None, months: list[str] | None = None) -> list[str]:
    """The same choice for job parameters, where partition pruning needs literals."""
    if last:
        end = as_of.year * 12 + as_of.month - 1
        return [f"{m // 12}_{m % 12 + 1:02d}" for m in range(end - last + 1, end + 1)]
    return [m.replace("-", "_") for m in months] if months else [as_of.strftime("%Y_%m")]


def report_range(as_of: Column, when: str = "yesterday", days: Column | int = 1) -> tuple[Column, Column]:
    """First and last day of a report, both included.

    ``when`` is ``yesterday`` (with ``days`` of look-back), ``today`` or one
    literal date; the last two ignore ``days``.
    """
    if when == "yesterday":
        end = F.date_sub(as_of, 1)
        back = (F.lit(days) if isinstance(days, int) else days) - 1
        return F.date_sub(end, back.cast("int")), end
    if when == "today":
        return as_of, as_of
    day = F.lit(date.fromisoformat(when))
    return day, day


def range_label(as_of: Column, when: str = "yesterday", days: Column | int = 1) -> Column:
    """Label of :func:`report_range`."""
    start, end = report_range(as_of, when, days)
    if when == "today":
        return F.concat(F.date_format(as_of, LABEL), F.lit(" (so far)"))
    if when != "yesterday":
        return F.lit(when)
    span = F.concat(F.date_format(start, "MMM dd"), F.lit(" – "), F.date_format(end, LABEL))
    one_day = (F.lit(days) if isinstance(days, int) else days) == 1
    return F.when(one_day, F.date_format(end, LABEL)).otherwise(span)
