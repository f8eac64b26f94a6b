from datetime import date

from conftest import plan_of
from pyspark.sql import functions as F

from outpulse.operators import traffic as TR
from outpulse.plans.collect import collect_traffic
from outpulse.session import run_dir
from outpulse.sources import archive as A

VIEWS = "repo STRING, date DATE, views BIGINT, unique_visitors BIGINT, _seq INT"


def incoming(spark, *rows):
    return spark.createDataFrame([("o/r", *r, n) for n, r in enumerate(rows)], VIEWS)


def test_month_scope_files_late_days_again(spark):
    march, april = date(2026, 3, 31), date(2026, 4, 2)
    for scope, want in (("archive_month", 1), ("all", 0)):
        root = run_dir(spark, "t")
        assert A.update_archive(spark, root, "views", incoming(spark, (march, 1, 1)), march, scope=scope) == 1
        assert A.update_archive(spark, root, "views", incoming(spark, (march, 1, 1)), april, scope=scope) == want
        assert A.read_archive(spark, root, "views", ["2026_04"]).count() == want


def test_update_is_repeatable_and_never_changes_rows(spark):
    root, day = run_dir(spark, "t"), date(2026, 4, 5)
    batch = incoming(spark, (date(2026, 4, 1), 9, 1), (date(2026, 4, 2), 3, 1), (date(2026, 4, 2), 4, 1))
    assert A.update_archive(spark, root, "views", batch, day) == 2
    before = sorted(A.read_archive(spark, root, "views").collect())
    assert A.update_archive(spark, root, "views", batch.withColumn("views", F.lit(77)), day) == 0
    assert sorted(A.read_archive(spark, root, "views").collect()) == before
    assert [r.views for r in sorted(before, key=lambda r: r.date)] == [9, 3]


def test_nothing_new_leaves_an_empty_archive(spark):
    root = run_dir(spark, "t")
    assert A.update_archive(spark, root, "clones", incoming(spark).select(
        "repo", "date", F.col("views").alias("clones"), F.col("unique_visitors").alias("unique_cloners"), "_seq"
    ), date(2026, 4, 1)) == 0
    assert A.read_archive(spark, root, "clones").count() == 0
    assert not A.ensure_archive(spark, root, "clones")
    assert A.ensure_archive(spark, root, "paths")


def test_months_prune_partitions(spark):
    root = run_dir(spark, "t")
    for day in (date(2026, 3, 1), date(2026, 4, 1)):
        A.update_archive(spark, root, "views", incoming(spark, (day, 1, 1)), day)
    df = A.read_archive(spark, root, "views", ["2026_04"])
    assert "PartitionFilters: [isnotnull(archive_month" in plan_of(df) or "PartitionFilters: [(archive_month" in plan_of(df)
    assert [r.date for r in df.collect()] == [date(2026, 4, 1)]
    assert "PushedFilters: [IsNotNull(date)" in plan_of(df.where(F.col("date") >= F.lit(date(2026, 4, 1))))
    assert A.read_archive(spark, root, "views", ["2025_01"]).count() == 0
    assert A.read_archive(spark, run_dir(spark, "absent"), "views").count() == 0


def test_csv_keeps_quotes_commas_and_missing_text_marks(spark):
    path = run_dir(spark, "csv")
    rows = [("o/r", date(2026, 4, 1), name, 1, 2) for name in ('a "b", c', "NA", "None", "é,")]
    df = spark.createDataFrame(rows, "repo STRING, fetched_date DATE, path STRING, views BIGINT, unique_visitors BIGINT")
    A.export_csv(df, path, "paths")
    assert sorted(A.import_csv(spark, path, "paths").collect()) == sorted(df.collect())


def test_union_keeps_differing_rows_and_date_dedupe_keeps_the_first(spark):
    rows = [("o/r", date(2026, 3, 31), 5, 1, "2026_03"), ("o/r", date(2026, 3, 31), 5, 1, "2026_04"),
            ("o/r", date(2026, 3, 31), 7, 1, "2026_05")]
    df = spark.createDataFrame(rows, "repo STRING, date DATE, views BIGINT, unique_visitors BIGINT, archive_month STRING")
    assert sorted(r.views for r in TR.distinct_rows(df, "views").collect()) == [5, 7]
    assert [r.views for r in TR.one_per_date(df, "views").collect()] == [5]


def test_sums_skip_missing_keys_only(spark):
    df = spark.createDataFrame([("r", None, 1), ("r", "NA", 2), ("r", "", 3), ("r", "NA", 4)], "repo STRING, referrer STRING, views BIGINT")
    got = {r.referrer: r.views for r in TR.sum_by(df, "referrer").collect()}
    assert got == {"NA": 6, "": 3}
    top = TR.top_keys(TR.sum_by(df, "referrer"), "referrer", n=1)
    assert "TakeOrderedAndProject" in plan_of(top)


def test_a_daily_run_can_be_repeated(spark):
    root, day = run_dir(spark, "t"), date(2026, 4, 5)
    point = '{"timestamp": "2026-04-%02dT00:00:00Z", "count": 5, "uniques": 2}'

    def landed(payload):
        return spark.createDataFrame([("o/r", payload)], "repo STRING, payload STRING")

    replies = {
        "views": landed('{"views": [' + ", ".join(point % d for d in (3, 4, 4)) + "]}"),
        "clones": landed("{}"),
        "referrers": landed('[{"referrer": "a", "count": 3, "uniques": 1}]'),
        "paths": landed("null"),
        "repo_stats": landed('{"stargazers_count": 9, "forks_count": 1, "subscribers_count": 2, "open_issues_count": 3}'),
    }
    want = {"views": 2, "clones": 0, "referrers": 1, "paths": 0, "repo_stats": 1}
    assert collect_traffic(spark, root, replies, day) == want
    assert collect_traffic(spark, root, replies, day) == dict.fromkeys(want, 0)
    assert collect_traffic(spark, root, replies, date(2026, 4, 6)) == {**dict.fromkeys(want, 0), "referrers": 1, "repo_stats": 1}
    assert A.read_archive(spark, root, "clones").count() == 0
