from datetime import date

import pytest
from pyspark.sql import functions as F

from outpulse.functions import dates as D


@pytest.mark.parametrize(
    "as_of, n, months, want",
    [
        (date(2026, 2, 15), 3, None, ["2025_12", "2026_01", "2026_02"]),
        (date(2026, 2, 15), 0, None, ["2026_02"]),
        (date(2026, 2, 15), None, ["2026-03", "2026-04"], ["2026_03", "2026_04"]),
        (date(2026, 2, 15), 1, ["2026-03"], ["2026_02"]),
        (date(2026, 3, 31), 14, None, None),
    ],
)
def test_last_months(one, as_of, n, months, want):
    count = F.lit(n).cast("int")
    got = one(D.last_months(F.lit(as_of), count, months))
    assert got == D.resolve_months(as_of, n, months)
    if want:
        assert got == want
    else:
        assert len(got) == n and got == sorted(got)


@pytest.mark.parametrize(
    "when, days, start, end, label",
    [
        ("yesterday", 1, date(2026, 4, 5), date(2026, 4, 5), "Apr 05, 2026"),
        ("yesterday", 7, date(2026, 3, 30), date(2026, 4, 5), "Mar 30 – Apr 05, 2026"),
        ("today", 7, date(2026, 4, 6), date(2026, 4, 6), "Apr 06, 2026 (so far)"),
        ("2026-04-01", 7, date(2026, 4, 1), date(2026, 4, 1), "2026-04-01"),
    ],
)
def test_report_range(one, when, days, start, end, label):
    as_of = F.lit(date(2026, 4, 6))
    got = [one(c) for c in D.report_range(as_of, when, days)]
    assert got == [start, end]
    assert one(D.range_label(as_of, when, days)) == label


def test_dates_from_text_and_epoch(one):
    assert one(D.iso_date(F.lit("2026-04-05T23:59:59Z"))) == date(2026, 4, 5)
    assert one(D.iso_date(F.lit("soon"))) is None
    assert one(D.epoch_date(F.lit(86399))) == date(1970, 1, 1)
    assert one(D.epoch_date(F.lit(-1))) == date(1969, 12, 31)
    assert one(D.epoch_seconds(F.lit("2024-03-01 01:02:03.9").cast("timestamp_ntz"))) == 1709254923
    assert one(D.archive_name("views", F.lit(date(2026, 4, 1)))) == "views_2026_04"


def test_dates_ignore_the_session_zone(spark, one):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(D.epoch_date(F.lit(1_706_659_200))) == date(2024, 1, 31)
        assert one(D.epoch_seconds(F.lit("2024-03-10 02:30:00").cast("timestamp_ntz"))) == 1710037800
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
