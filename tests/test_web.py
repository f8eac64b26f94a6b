import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from outpulse.operators import web as W
from outpulse.sources.firsts import read_firsts, update_firsts

HITS = (
    "property_id STRING, event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING, page_path STRING, "
    "page_title STRING, source STRING, medium STRING, country STRING, device_category STRING"
)
T0 = datetime(2024, 1, 1)


def random_hits(seed=7, n=1500):
    """Two properties, a user with most hits, equal timestamps, pauses right at the gap."""
    rng = random.Random(seed)
    clock = defaultdict(lambda: T0 + timedelta(seconds=rng.random() * 3600))
    rows = []
    for i in range(n):
        p, u = rng.choice(["p0", "p0", "p1"]), rng.choice([1, 1, 1, 1, 2, 3, 4])
        clock[p, u] += timedelta(seconds=rng.choice([0, 1, 60, 599.5, 600, 600.000001, 900, 5000]))
        rows.append((p, i, u, clock[p, u], rng.choice(["view", "click"]), f"/{rng.randrange(3)}", "t", f"s{i % 5}",
                     f"m{i % 3}", f"c{u % 2}", f"d{i % 2}"))
    return rows


def brute_sessions(rows, gap):
    sessions, last = {}, {}
    by_user = defaultdict(list)
    for r in rows:
        by_user[r[0], r[2]].append(r)
    for user, hits in by_user.items():
        hits.sort(key=lambda r: (r[3], r[1]))
        for h in hits:
            if user not in last or h[3] > last[user][1][-1][3] + timedelta(seconds=gap):
                last[user] = (h[3], [h])
                sessions[user, h[3]] = last[user][1]
            else:
                last[user][1].append(h)
    return sessions


def test_sessions_equal_a_walk_over_the_hits(spark):
    rows = random_hits()
    want = {
        (p, u, start, len(hits), hits[0][7], hits[0][8]) for ((p, u), start), hits in brute_sessions(rows, 600).items()
    }
    df = spark.createDataFrame(rows, HITS).repartition(5)
    got = W.sessions(df, 600).collect()
    assert {(r.property_id, r.user_id, r.session_start, r.session_hits, r.session_source, r.session_medium) for r in got} == want
    assert len(got) == len(want)
    assert W.with_sessions(df, 600).count() == len(rows)


METRICS = ["sessions", "totalUsers", "newUsers", "screenPageViews", "bounceRate", "averageSessionDuration"]
DAYS = (date(2024, 1, 2), date(2024, 1, 3))


def brute_report(rows, dims, days):
    """Metrics by a walk over all hits."""
    inside = lambda ts: days[0] <= ts.date() <= days[1]
    first_hit = {}
    for r in rows:
        first_hit[r[0], r[2]] = min(first_hit.get((r[0], r[2]), r[3]), r[3])
    groups = defaultdict(lambda: {"s": {}, "u": set(), "v": 0, "any": False})
    for ((p, u), start), hits in brute_sessions(rows, 600).items():
        for h in hits:
            value = {"sessionSource": hits[0][7], "sessionMedium": hits[0][8], "country": h[9], "deviceCategory": h[10], "pagePath": h[5]}
            g = groups[(p, *[value[d] for d in dims])]
            if inside(start):
                g["s"][u, start] = (len(hits), int(hits[-1][3].timestamp()) - int(start.timestamp()))
                g["any"] = True
            if inside(h[3]):
                g["any"] = True
                g["u"] |= {u} - {None}
                g["v"] += h[4] == "view"
    want = set()
    for key, g in groups.items():
        if dims and not g["any"]:
            continue
        n = len(g["s"])
        bounced, seconds = sum(c == 1 for c, _ in g["s"].values()), sum(s for _, s in g["s"].values())
        new = sum(inside(first_hit[key[0], u]) for u in g["u"])
        want.add((*key, n, len(g["u"]), new, g["v"], bounced / n if n else 0.0, seconds / n if n else 0.0))
    return want


def long_sessions():
    """Sessions that reach into the range and out of it by days, of a known and of an unknown user, and one just beyond the gap."""
    rows = random_hits()
    for user, since, until in ((8, -5, 12), (None, 1.3, 1.9), (9, 2.5, 9), (10, -3, 1.01), (None, 3.4, 3.7)):
        at = T0 + timedelta(days=since)
        while at < T0 + timedelta(days=until):
            rows.append(("p0", len(rows), user, at, "view", "/long", "t", f"s{len(rows) % 5}", "m0", "c0", f"d{len(rows) % 2}"))
            at += timedelta(seconds=600)
    edge = datetime(2024, 1, 2)
    rows += [("p1", 90_000 + i, 11, edge + timedelta(seconds=s), "view", "/", "t", f"e{i}", "m", "c", "d") for i, s in enumerate((-601, 0, 600, 1200.5))]
    return rows


@pytest.mark.parametrize("dims", [[], ["sessionSource"], ["country"], ["deviceCategory", "sessionMedium"]])
def test_report_equals_distinct_counts(spark, dims):
    rows = random_hits()
    got = W.report(spark.createDataFrame(rows, HITS), dims, METRICS, DAYS, limit=1000, gap=600).collect()
    assert {tuple(r) for r in got} == brute_report(rows, dims, DAYS)


def test_sessions_across_both_ends_are_read_whole(spark, tmp_path, monkeypatch):
    """The range's days are read, then, in bounded reads, what its open sessions need; one pass gives all reports."""
    rows, path = long_sessions(), str(tmp_path / "hits")
    spark.createDataFrame(rows, HITS).write.parquet(path)
    hits, plans = spark.read.parquet(path), []

    def recorded(df, name, stored=W.store):
        plans.append(plan_of(df))
        return stored(df, name)

    monkeypatch.setattr(W, "store", recorded)
    firsts = W.first_hits(hits)
    dims = ["sessionSource", "deviceCategory"]
    got = W.report(hits, dims, METRICS, DAYS, limit=1000, gap=600, firsts=firsts).collect()
    assert {tuple(r) for r in got} == brute_report(rows, dims, DAYS)
    scans = [line for plan in plans for line in plan.split("\n") if "FileScan" in line and "tmp_path" not in line and path in line]
    assert len(scans) >= 5 and all("GreaterThanOrEqual(ts," in line and "LessThan(ts," in line for line in scans)

    wanted = {"all": ([], None, 1), "s": (["sessionSource"], "sessions", 1000), "d": (["deviceCategory"], None, 1000),
              "c": (["country", "pagePath"], "sessions", 1000)}
    table = W.reports(hits, wanted, DAYS, 600, firsts)
    for name, (dimensions, _, _) in wanted.items():
        some = table.where(F.col("report") == name).select("property_id", *dimensions, *METRICS).collect()
        assert {tuple(r) for r in some} == brute_report(rows, dimensions, DAYS)
    assert plan_of(table).count("Expand") == 1


def test_reports_rank_and_limit(spark):
    hits = spark.createDataFrame(random_hits(), HITS)
    table = W.reports(hits, {"p": (["pagePath", "pageTitle"], "screenPageViews", 2), "o": ([], None, 1)}, DAYS, 600)
    one = W.report(hits, ["pagePath", "pageTitle"], ["screenPageViews", "totalUsers"], DAYS, [("screenPageViews", True)], 2, 600)
    some = table.where("report = 'p'").select("property_id", "pagePath", "pageTitle", "screenPageViews", "totalUsers")
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, one.collect()))
    idle = W.reports(hits, {"o": ([], None, 1)}, (date(2030, 1, 1), date(2030, 1, 2)), 600).collect()
    assert {(r.property_id, r.sessions, r.averageSessionDuration) for r in idle} == {("p0", 0, 0.0), ("p1", 0, 0.0)}


def test_first_hits_grow_by_days(spark, tmp_path):
    rows = long_sessions()
    hits, path = spark.createDataFrame(rows, HITS), str(tmp_path / "firsts")
    assert read_firsts(spark, path).count() == 0
    for day in (date(2024, 1, 1), date(2024, 1, 4), date(2024, 1, 3), date(2024, 1, 4), date(2024, 1, 20)):
        update_firsts(spark, path, hits, day)
    want = {}
    for r in rows:
        want[r[0], r[2]] = min(want.get((r[0], r[2]), r[3]), r[3])
    assert {(r[0], r[1]): r[2] for r in read_firsts(spark, path).collect()} == want
    assert read_firsts(spark, path).count() == len(want)


def test_overview_has_zeros_without_data(spark):
    r = W.overview(spark.createDataFrame(random_hits(n=50), HITS), (date(2030, 1, 1), date(2030, 1, 2))).first()
    assert tuple(r)[1:] == (0, 0, 0, 0, 0.0, 0.0)


def test_unknown_names_are_rejected(spark):
    with pytest.raises(ValueError):
        W.report(spark.createDataFrame([], HITS), ["browser"], ["sessions"], (T0.date(), T0.date()))


def test_hit_reports_need_no_sessions_and_prune(spark, tmp_path):
    path = str(tmp_path / "hits")
    spark.createDataFrame(random_hits(n=50), HITS).write.parquet(path)
    plan = plan_of(W.top_pages(spark.read.parquet(path), (date(2024, 1, 2), date(2024, 1, 3))))
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in plan and "WindowGroupLimit" in plan
    assert "medium" not in plan and "lag(" not in plan
    # Without session dimensions no text is carried.
    slots, _ = W.range_sessions(spark.read.parquet(path), (date(2024, 1, 2), date(2024, 1, 3)), entry=False)
    assert "entry" not in slots.columns


def test_hits_without_a_user_stay(spark):
    """They are one unknown user: seen in sessions and views, never counted as a user."""
    columns = "property_id STRING, user_id LONG, event_type STRING, page_path STRING, page_title STRING, country STRING, device_category STRING, source STRING, medium STRING"
    rows = [("p", u, "view", "/", "t", "DE", "desktop", "s", "m") for u in (1, None, None)]
    hits = spark.createDataFrame(rows, columns).withColumn("event_id", F.monotonically_increasing_id()).withColumn(
        "ts", F.lit("2026-01-05 10:00:00").cast("timestamp_ntz"))
    assert W.with_sessions(hits).count() == 3
    day = (date(2026, 1, 5), date(2026, 1, 5))
    for dimensions in ([], ["country"]):
        got = W.report(hits, dimensions, ["sessions", "screenPageViews", "totalUsers", "newUsers"], day).first()
        assert (got.sessions, got.screenPageViews, got.totalUsers, got.newUsers) == (2, 3, 1, 1)
