from datetime import date

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from outpulse.catalog import views as V
from outpulse.catalog.stream_queries import land_files
from outpulse.operators.keyed import append_new
from outpulse.session import run_dir
from outpulse.sources import archive as A
from outpulse.sources import seen as S
from outpulse.streaming import jobs as J

SCHEMA = "repo STRING, date DATE, views BIGINT, unique_visitors BIGINT, _seq INT"
DAY = date(2026, 4, 5)


def land(spark, path, rows):
    spark.createDataFrame([("o/r", *r) for r in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_archive_stream_equals_batch_and_repeats_safely(spark):
    base = run_dir(spark, "t")
    landing, root = f"{base}/landing", f"{base}/archive"
    schema = spark.createDataFrame([], SCHEMA).schema
    first = [(date(2026, 4, 1), 1, 1, 1), (date(2026, 4, 1), 2, 1, 2), (date(2026, 4, 2), 3, 1, 3)]
    later = [(date(2026, 4, 2), 9, 9, 1), (date(2026, 4, 3), 4, 1, 2)]
    land(spark, landing, first)

    def run(state):
        stream = J.landing_stream(spark, landing, schema, files=1)
        J.run_archive_stream(stream, root, "views", DAY, f"{base}/{state}").awaitTermination()
        return sorted((r.date.day, r.views) for r in A.read_archive(spark, root, "views").collect())

    assert run("a") == [(1, 1), (2, 3)]
    assert run("a") == [(1, 1), (2, 3)]  # same state: nothing landed since
    land(spark, landing, later)
    assert run("a") == [(1, 1), (2, 3), (3, 4)]
    assert run("fresh") == [(1, 1), (2, 3), (3, 4)]  # state lost: all is read again, nothing is added

    empty = A.read_archive(spark, f"{base}/none", "views")
    batch = spark.createDataFrame([("o/r", *r[:3], n) for n, r in enumerate(first + later)], SCHEMA)
    want = append_new(empty, batch, ["repo", "date"])
    assert sorted((r.date.day, r.views) for r in want.collect()) == [(1, 1), (2, 3), (3, 4)]


def test_streams_ask_for_utc(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    events = J.landing_stream(spark, "/root/testdata/sf0.001", V.table(spark, "/root/testdata/sf0.001", "events").schema,
                              pathGlobFilter="events.parquet")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError):
            J.daily_stream(events, ["event_type"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_dedupe_drops_repeats_inside_the_look_back(spark):
    base = run_dir(spark, "t")
    rows = [("2026-04-01 00:00:00", "a"), ("2026-04-03 00:00:00", "a"), ("2026-04-02 00:00:00", "b")]
    df = spark.createDataFrame(rows, "ts STRING, k STRING").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.write.parquet(f"{base}/in")
    stream = J.landing_stream(spark, f"{base}/in", df.schema)
    J.run_to_table(J.dedupe_stream(stream, ["k"]), f"{base}/out", f"{base}/state").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(f"{base}/out").collect()) == ["a", "b"]


def test_a_replayed_batch_returns_its_first_count(spark, monkeypatch):
    """Whether it had ended, or died with its rows in the archive, or half of them, or none."""
    root = f"{run_dir(spark, 't')}/archive"
    batch = spark.createDataFrame([("o/r", date(2026, 4, d), d, 1, d) for d in (1, 2, 2, 3)], SCHEMA)

    def append(no, df=batch):
        return A.append_batch(spark, root, "views", df, DAY, "s", no)

    def days():
        return sorted(r.date.day for r in A.read_archive(spark, root, "views").collect())

    A.write_archive(batch.where("views = 3"), root, "views", DAY)
    assert [append(0), append(0)] == [2, 2]
    assert append(1) == 0 and days() == [1, 2, 3]
    assert append(2, batch.limit(0)) == 0

    more = spark.createDataFrame([("o/r", date(2026, 4, d), d, 1, d) for d in (4, 5, 6)], SCHEMA)
    write, calls = A.write_archive, []

    def dies(df, *rest):
        calls.append(1)
        if len(calls) == 1:
            write(df.where("views = 4"), *rest)
            raise InterruptedError
        write(df, *rest)

    monkeypatch.setattr(A, "write_archive", dies)
    with pytest.raises(InterruptedError):
        append(3, more)
    assert append(3, more) == 3 and append(3, more) == 3
    assert days() == [1, 2, 3, 4, 5, 6]
    assert sorted((r.batch_id, r.added) for r in A.finished_batches(spark, root, "views").collect()) == [(0, 2), (1, 0), (2, 0), (3, 3)]


def test_a_batch_is_made_once_and_counted_exactly(spark):
    """The batch is made once, and neither it nor the month is read again for the count."""
    root, made = f"{run_dir(spark, 't')}/archive", spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(n):
        made.add(1)
        return n

    batch = spark.createDataFrame([("o/r", date(2026, 4, d), d, 1, d) for d in (1, 2, 2, 3)], SCHEMA).withColumn("_seq", seen("_seq"))
    assert A.update_archive(spark, root, "views", batch, DAY) == 3
    assert made.value == 4
    assert A.update_archive(spark, root, "views", batch, DAY) == 0
    assert A.update_archive(spark, root, "views", batch.limit(0), DAY) == 0
    assert A.read_archive(spark, root, "views").count() == 3


def test_keys_that_return_after_the_look_back_stay_back(spark):
    """The state lets them pass, the table does not; the state holds the look-back and no more."""
    base = run_dir(spark, "t")
    schema = "ts TIMESTAMP_NTZ, k LONG"
    for n, day in enumerate(range(0, 120, 6)):
        rows = spark.range(40).select((F.lit("2026-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(day))).alias("ts"), (F.col("id") + 40 * n).alias("k"))
        back = rows.limit(1).withColumn("k", F.lit(7).cast("long"))
        rows.union(back).union(back.withColumn("k", F.lit(None).cast("long"))).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = J.landing_stream(spark, f"{base}/in", spark.createDataFrame([], schema).schema, files=1)
    run = J.run_dedupe_stream(stream, ["k"], f"{base}/out", f"{base}/state")
    run.awaitTermination()
    got = [r.k for r in spark.read.parquet(f"{base}/out").collect()]
    assert sorted(got, key=str) == sorted([*range(800), None], key=str)
    states = [p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]]
    assert len(states) >= 20 and max(states) <= 6 * 42 < 800
    passed = sum(p["stateOperators"][0]["numRowsUpdated"] for p in run.recentProgress if p["stateOperators"])
    assert passed > 801  # some keys did leave the state and came through again


def test_a_dedupe_batch_adds_one_file_to_a_bucket(spark):
    """Its files are bounded by the buckets, not by tasks times buckets."""
    base = run_dir(spark, "t")
    rows = spark.range(6000).select(F.lit("2026-01-01").cast("timestamp_ntz").alias("ts"), F.expr("nullif(id % 3000, 7)").alias("k"))
    rows.write.parquet(f"{base}/in")
    J.run_dedupe_stream(J.landing_stream(spark, f"{base}/in", rows.schema), ["k"], f"{base}/out", f"{base}/state").awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    assert sorted((r.k for r in out.collect()), key=str) == sorted([*(k for k in range(3000) if k != 7), None], key=str)
    folders = [f.rsplit("/", 1)[0] for f in out.inputFiles()]
    assert len(folders) == len(set(folders)) > 200


def test_a_part_is_landed_as_exactly_so_many_files(spark):
    """Few rows or none included, since a micro-batch takes files by their number."""
    path = f"{run_dir(spark, 't')}/in"
    for n, rows in enumerate((1000, 2, 0, 5)):
        land_files(spark.range(rows), path, 4, 4 * n)
        assert len(spark.read.schema("id LONG").parquet(path).inputFiles()) == 4 * (n + 1)
    assert spark.read.schema("id LONG").parquet(path).count() == 1007


def test_unseen_reads_the_buckets_of_its_urls(spark):
    path = f"{run_dir(spark, 't')}/seen"
    assert S.read_bucketed(spark, path).count() == 0
    rows = spark.range(2000).select(F.concat(F.lit("u"), F.col("id")).alias("url"), F.lit("t").alias("title"), F.lit(DAY).alias("date_seen"))
    S.append_bucketed(rows, path)
    assert S.read_bucketed(spark, path).count() == 2000
    batch = spark.createDataFrame([("u5",), ("u77",), ("new",)], "url STRING")
    found = S.read_bucketed(spark, path, batch)
    plan = plan_of(found)
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert 2 <= found.count() < 100
    assert [r.url for r in batch.join(found, "url", "left_anti").collect()] == ["new"]
