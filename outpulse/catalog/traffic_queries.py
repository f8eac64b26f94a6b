"""Queries over repository traffic: landed replies, archives, rankings, charts, the repository digest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from outpulse.catalog import views as V
from outpulse.catalog.registry import query
from outpulse.catalog.sqlviews import values
from outpulse.functions import dates as D
from outpulse.operators import keyed as K
from outpulse.operators import traffic as TR
from outpulse.plans import charts as C
from outpulse.plans import collect as P
from outpulse.plans import digests as G
from outpulse.schemas import ARCHIVES
from outpulse.session import run_dir, store
from outpulse.sources import archive as A
from outpulse.sources import landing as L

ALL = D.resolve_months(V.ORDERS_AS_OF, V.ALL_MONTHS)
SIX = D.resolve_months(V.CUT, 6)
KEYS = ARCHIVES["referrers"].all_keys


# Landed replies


@query(
    "src_traffic_json",
    """
SELECT 'views' AS kind, repo, date, views AS n, unique_visitors AS uniques FROM v_views UNION ALL
SELECT 'clones', repo, date, clones, unique_cloners FROM v_clones""",
)
def src_traffic_json(spark, sf):
    parts = []
    for kind, (n, u) in L.TRAFFIC_NAMES.items():
        df = L.read_traffic(V.landed_traffic(spark, sf, kind), kind)
        parts.append(df.select(F.lit(kind).alias("kind"), "repo", "date", F.col(n).alias("n"), F.col(u).alias("uniques")))
    return parts[0].unionByName(parts[1])


@query(
    "src_traffic_totals",
    """
SELECT 'views' AS kind, repo, date_diff('day', DATE '2024-01-01', date) // 14 AS block,
       CAST(sum(views) AS BIGINT) AS count, CAST(sum(unique_visitors) AS BIGINT) AS uniques FROM v_views GROUP BY ALL
UNION ALL
SELECT 'clones', repo, date_diff('day', DATE '2024-01-01', date) // 14, CAST(sum(clones) AS BIGINT),
       CAST(sum(unique_cloners) AS BIGINT) FROM v_clones GROUP BY ALL""",
)
def src_traffic_totals(spark, sf):
    parts = [
        L.read_traffic_totals(V.landed_traffic(spark, sf, kind), kind, keep=("repo", "block")).withColumn("kind", F.lit(kind))
        for kind in L.TRAFFIC_NAMES
    ]
    return parts[0].unionByName(parts[1])


@query(
    "src_popular_json",
    """
SELECT 'referrers' AS kind, repo, fetched_date, referrer AS name, views, unique_visitors FROM v_referrers UNION ALL
SELECT 'paths', repo, fetched_date, path, views, unique_visitors FROM v_paths""",
)
def src_popular_json(spark, sf):
    parts = []
    for kind, name in L.POPULAR_NAMES.items():
        df = L.read_popular(V.landed_popular(spark, sf, kind), kind, F.col("run_date"))
        parts.append(df.select(F.lit(kind).alias("kind"), "repo", "fetched_date", F.col(name).alias("name"), "views",
                               "unique_visitors"))
    return parts[0].unionByName(parts[1])


@query("src_repo_info", "SELECT repo, date, stars, forks, watchers, open_issues FROM v_repo_stats")
def src_repo_info(spark, sf):
    return L.read_repo_info(V.landed_info(spark, sf), F.col("run_date"))


@query(
    "proj_rename",
    """
SELECT o_orderkey AS stars, o_custkey AS forks, date_part('year', o_orderdate) AS watchers,
       length(o_orderpriority) AS open_issues, o_orderstatus AS repo, CAST(o_orderdate AS DATE) AS date FROM orders""",
)
def proj_rename(spark, sf):
    reply = F.struct(
        F.col("o_orderkey").alias("stargazers_count"),
        F.col("o_custkey").alias("forks_count"),
        F.year("o_orderdate").alias("subscribers_count"),
        F.length("o_orderpriority").alias("open_issues_count"),
    )
    landed = V.table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("repo"), F.to_json(reply).alias("payload"), "o_orderdate"
    )
    return L.read_repo_info(landed, F.col("o_orderdate"))


@query(
    "proj_snapshot_date",
    f"SELECT repo, DATE '{V.ORDERS_AS_OF}' AS fetched_date, path, views, unique_visitors FROM v_paths",
)
def proj_snapshot_date(spark, sf):
    return L.read_popular(V.landed_popular(spark, sf, "paths"), "paths", V.ORDERS_AS_OF).drop("pos")


# Archives


def _archived(spark, sf, name):
    root = run_dir(spark, name)
    for kind, df, day in (
        ("referrers", V.referrers(spark, sf), "fetched_date"),
        ("repo_stats", V.repo_stats(spark, sf), "date"),
    ):
        A.write_archive(df, root, kind, F.col(day))
    return root


@query(
    "archive_read_months",
    f"""
SELECT repo, fetched_date, referrer, views, unique_visitors, archive_month FROM v_referrers
WHERE archive_month IN (SELECT m FROM {values((m,) for m in SIX)} t(m))""",
)
def archive_read_months(spark, sf):
    root = run_dir(spark, "read-months")
    A.write_archive(V.referrers(spark, sf), root, "referrers", F.col("fetched_date"))
    # A month nobody wrote is skipped, and so is an archive nobody wrote.
    wanted = A.read_archive(spark, root, "referrers", [*SIX, "1901_01"])
    return wanted.unionByName(A.read_archive(spark, run_dir(spark, "absent"), "referrers", SIX))


@query(
    "archive_month_partition",
    """
SELECT kind, repo, archive_month, count(*) AS row_count, CAST(sum(n) AS BIGINT) AS total FROM (
  SELECT 'referrers' AS kind, repo, archive_month, views AS n FROM v_referrers UNION ALL
  SELECT 'repo_stats', repo, archive_month, watchers FROM v_repo_stats) GROUP BY ALL""",
)
def archive_month_partition(spark, sf):
    root = _archived(spark, sf, "partition")
    parts = [
        A.read_archive(spark, root, kind).select(F.lit(kind).alias("kind"), "repo", "archive_month", F.col(n).alias("n"))
        for kind, n in (("referrers", "views"), ("repo_stats", "watchers"))
    ]
    rows = parts[0].unionByName(parts[1]).groupBy("kind", "repo", "archive_month")
    return rows.agg(F.count("*").alias("row_count"), F.sum("n").alias("total"))


@query(
    "archive_ensure",
    """
SELECT 'clones' AS kind, true AS created, CAST(NULL AS VARCHAR) AS repo, CAST(0 AS BIGINT) AS row_count UNION ALL
SELECT 'referrers', false, repo, count(*) FROM v_referrers GROUP BY repo""",
)
def archive_ensure(spark, sf):
    root = run_dir(spark, "ensure")
    A.write_archive(V.referrers(spark, sf), root, "referrers", F.col("fetched_date"))
    created = {kind: A.ensure_archive(spark, root, kind) for kind in ("clones", "referrers")}
    flag = lambda kind: (F.lit(kind).alias("kind"), F.lit(created[kind]).alias("created"))
    empty = A.read_archive(spark, root, "clones").agg(F.count("*").alias("row_count"))
    full = A.read_archive(spark, root, "referrers").groupBy("repo").agg(F.count("*").alias("row_count"))
    return (
        empty.select(*flag("clones"), F.lit(None).cast("string").alias("repo"), "row_count")
        .unionByName(full.select(*flag("referrers"), "repo", "row_count"))
    )


@query("csv_roundtrip", "SELECT repo, fetched_date, path, views, unique_visitors FROM v_paths")
def csv_roundtrip(spark, sf):
    path = run_dir(spark, "csv")
    A.export_csv(V.paths(spark, sf), path, "paths")
    return A.import_csv(spark, path, "paths")


_LINES = """
SELECT repo, path, CASE n % 8 WHEN 1 THEN repo || ',' || fetched_date
                              WHEN 2 THEN repo || ',' || fetched_date || ',' || path || ',' || views || ',' || unique_visitors || ',more'
                              WHEN 3 THEN repo || ',' || fetched_date || ',' || path || ',many,' || unique_visitors
                              WHEN 4 THEN repo || ',2001-13-45,' || path || ',' || views || ',' || unique_visitors
                              ELSE repo || ',' || fetched_date || ',' || path || ',' || views || ',' || unique_visitors END AS line, n
FROM (SELECT *, (views * 31 + unique_visitors * 7 + day(fetched_date)) % 16 AS n FROM v_paths)"""


@query(
    "csv_rejects",
    f"""
SELECT repo, n % 8 BETWEEN 1 AND 4 AS rejected, count(*) AS lines, md5(string_agg(line, chr(10) ORDER BY line)) AS digest
FROM ({_LINES}) GROUP BY ALL""",
)
def csv_rejects(spark, sf):
    """Archive lines, some cut short, too long, or with numbers and dates that are none; all come out on one side."""
    n = (F.col("views") * 31 + F.col("unique_visitors") * 7 + F.dayofmonth("fetched_date")) % 16 % 8
    parts = ["repo", F.col("fetched_date").cast("string"), "path", F.col("views").cast("string"), F.col("unique_visitors").cast("string")]
    cut = {1: parts[:2], 2: [*parts, F.lit("more")], 3: [*parts[:3], F.lit("many"), parts[4]], 4: [parts[0], F.lit("2001-13-45"), *parts[2:]]}
    line = F.concat_ws(",", *parts)
    for k, some in cut.items():
        line = F.when(n == k, F.concat_ws(",", *some)).otherwise(line)
    path = run_dir(spark, "csv-lines")
    V.paths(spark, sf).select(line.alias("line")).write.text(path, lineSep="\n")
    rows, rejects = A.import_csv_checked(spark, path, "paths", header=False)
    good = rows.select("repo", F.lit(False).alias("rejected"), F.concat_ws(",", *parts).alias("line"))
    bad = rejects.select(F.split("line", ",")[0].alias("repo"), F.lit(True).alias("rejected"), "line")
    lines = good.unionByName(bad).groupBy("repo", "rejected").agg(F.count("*").alias("lines"), F.array_sort(F.collect_list("line")).alias("l"))
    return lines.select("repo", "rejected", "lines", F.md5(F.array_join("l", "\n")).alias("digest"))


NEW_ROWS = f"""
SELECT repo, fetched_date, referrer, views, unique_visitors, _seq FROM v_incoming i
WHERE NOT EXISTS (SELECT 1 FROM v_existing e WHERE e.repo = i.repo AND e.fetched_date = i.fetched_date
                  AND e.referrer = i.referrer)
QUALIFY row_number() OVER (PARTITION BY repo, fetched_date, referrer ORDER BY _seq) = 1"""


@query("append_new_rows", NEW_ROWS)
def append_new_rows(spark, sf):
    return K.append_new(V.existing(spark, sf), V.incoming(spark, sf), KEYS)


@query(
    "archive_update",
    f"""
SELECT repo, fetched_date, referrer, views, unique_visitors, archive_month, 'before' AS origin FROM v_existing UNION ALL
SELECT repo, fetched_date, referrer, views, unique_visitors, '{V.ORDERS_AS_OF:%Y_%m}', 'added' FROM ({NEW_ROWS})""",
)
def archive_update(spark, sf):
    root = run_dir(spark, "update")
    A.write_archive(V.existing(spark, sf), root, "referrers", F.col("fetched_date"))
    A.update_archive(spark, root, "referrers", V.incoming(spark, sf), V.ORDERS_AS_OF)
    if A.update_archive(spark, root, "referrers", V.incoming(spark, sf), V.ORDERS_AS_OF):
        raise AssertionError("a repeated run must add nothing")
    origin = F.when(F.col("fetched_date") < F.lit(V.CUT), "before").otherwise("added")
    return A.read_archive(spark, root, "referrers").withColumn("origin", origin)


@query(
    "set_new_keys",
    """
SELECT DISTINCT repo, fetched_date, referrer FROM v_incoming EXCEPT SELECT repo, fetched_date, referrer FROM v_existing""",
)
def set_new_keys(spark, sf):
    return K.new_keys(V.existing(spark, sf), V.incoming(spark, sf), KEYS)


@query(
    "agg_added_counts",
    f"""
SELECT 'referrers' AS kind, repo, count(*) AS added FROM ({NEW_ROWS}) GROUP BY repo UNION ALL
SELECT 'repo_stats', repo, count(*) FROM v_repo_stats WHERE date >= DATE '{V.CUT}' GROUP BY repo""",
)
def agg_added_counts(spark, sf):
    stats = V.repo_stats(spark, sf).withColumn("_seq", F.lit(1))
    return TR.added_counts(
        {
            "referrers": K.append_new(V.existing(spark, sf), V.incoming(spark, sf), KEYS),
            "repo_stats": K.append_new(stats.where(F.col("date") < F.lit(V.CUT)), stats, ["repo", "date"]),
        }
    )


@query(
    "set_union_months",
    "SELECT DISTINCT repo, fetched_date, referrer, views, unique_visitors FROM v_referrers",
)
def set_union_months(spark, sf):
    root = run_dir(spark, "union-months")
    archive = V.referrers(spark, sf)
    A.write_archive(archive, root, "referrers", F.col("fetched_date"))
    # The same rows filed again under the next month are identical but for the month.
    A.write_archive(archive, root, "referrers", F.add_months("fetched_date", 1))
    return TR.distinct_rows(A.read_archive(spark, root, "referrers", [*ALL, "2001_09"]), "referrers")


@query(
    "dedupe_rows",
    """
SELECT repo, date, stars, forks, watchers, open_issues FROM v_repo_stats UNION
SELECT repo, date, stars + 1, forks, watchers, open_issues FROM v_repo_stats""",
)
def dedupe_rows(spark, sf):
    refiled = V.refiled_stats(spark, sf)
    return TR.distinct_rows(refiled.unionByName(refiled.withColumn("archive_month", F.lit("2001_09"))), "repo_stats")


@query("dedupe_by_date", "SELECT repo, date, stars, forks, watchers, open_issues FROM v_repo_stats")
def dedupe_by_date(spark, sf):
    return TR.one_per_date(V.refiled_stats(spark, sf), "repo_stats")


@query(
    "collect_traffic",
    f"""
SELECT *, '{V.ORDERS_AS_OF:%Y_%m}' AS archive_month FROM (
  SELECT 'views' AS kind, repo, date AS day, NULL AS name, views AS n FROM v_views UNION ALL
  SELECT 'clones', repo, date, NULL, clones FROM v_clones UNION ALL
  SELECT 'referrers', repo, fetched_date, referrer, views FROM v_referrers UNION ALL
  SELECT 'paths', repo, fetched_date, path, views FROM v_paths UNION ALL
  SELECT 'repo_stats', repo, date, NULL, stars FROM v_repo_stats)""",
)
def collect_traffic(spark, sf):
    """Every landed reply of all five datasets in one run."""
    root = run_dir(spark, "collect")
    replies = {kind: V.landed_traffic(spark, sf, kind) for kind in L.TRAFFIC_NAMES}
    replies |= {kind: V.landed_popular(spark, sf, kind) for kind in L.POPULAR_NAMES}
    replies["repo_stats"] = V.landed_info(spark, sf)
    P.collect_traffic(spark, root, replies, V.ORDERS_AS_OF, F.col("run_date"))
    parts = []
    for kind, spec in ARCHIVES.items():
        name = F.col(L.POPULAR_NAMES[kind]) if kind in L.POPULAR_NAMES else F.lit(None).cast("string")
        count = next(c for c in spec.fields if c not in spec.keys)
        parts.append(
            A.read_archive(spark, root, kind).select(
                F.lit(kind).alias("kind"), "repo", F.col(spec.date).alias("day"), name.alias("name"),
                F.col(count).alias("n"), "archive_month",
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


# Series, sums and rankings

DAILY = """
SELECT coalesce(v.repo, c.repo) AS repo, coalesce(v.date, c.date) AS date, views, unique_visitors, clones, unique_cloners
FROM v_views v FULL JOIN v_clones c ON v.repo = c.repo AND v.date = c.date"""


@query("join_daily_series", DAILY)
def join_daily_series(spark, sf):
    return TR.align_daily(V.views(spark, sf).drop("archive_month"), V.clones(spark, sf).drop("archive_month"))


@query("sort_daily", "SELECT repo, date, stars, forks FROM v_repo_stats ORDER BY date, repo")
def sort_daily(spark, sf):
    return TR.ascending(V.repo_stats(spark, sf).select("repo", "date", "stars", "forks"))


@query(
    "agg_daily_traffic",
    """
SELECT 'org/r' || (user_id % 3) AS repo, event_type, CAST(ts AS DATE) AS date, count(*) AS count,
       count(DISTINCT user_id) AS uniques FROM events GROUP BY ALL""",
)
def agg_daily_traffic(spark, sf):
    return TR.daily_traffic(V.events(spark, sf), ["repo", "event_type"])


TRAILING = f"""
SELECT 'org/r' || (user_id % 3) AS repo, event_type, count(*) AS count, count(DISTINCT user_id) AS uniques FROM events
WHERE ts >= DATE '{V.EVENTS_AS_OF}' - INTERVAL 14 DAY AND ts < DATE '{V.EVENTS_AS_OF}' GROUP BY ALL"""


@query("agg_trailing_totals", TRAILING)
def agg_trailing_totals(spark, sf):
    return TR.trailing_totals(V.events(spark, sf), ["repo", "event_type"], V.EVENTS_AS_OF)


@query(
    "agg_trailing_sketches",
    f"""
SELECT repo, event_type, count, uniques, true AS within FROM ({TRAILING})""",
)
def agg_trailing_sketches(spark, sf):
    """Fourteen stored daily sketches united, held against the exact count."""
    by = ["repo", "event_type"]
    daily = store(TR.daily_sketches(V.events(spark, sf), by), "sketches")
    estimate = TR.trailing_from_sketches(daily, by, V.EVENTS_AS_OF).withColumnRenamed("uniques", "estimate").drop("count")
    exact = TR.trailing_totals(V.events(spark, sf), by, V.EVENTS_AS_OF)
    within = F.abs(F.col("estimate") - F.col("uniques")) <= F.greatest(0.03 * F.col("uniques"), F.lit(1.0))
    return exact.join(estimate, by).select(*by, "count", "uniques", within.alias("within"))


@query("agg_referrer_views", "SELECT repo, referrer, CAST(sum(views) AS BIGINT) AS views FROM v_referrers GROUP BY ALL")
def agg_referrer_views(spark, sf):
    return TR.sum_by(V.referrers(spark, sf), "referrer")


@query("agg_path_views", "SELECT repo, path, CAST(sum(views) AS BIGINT) AS views FROM v_paths GROUP BY ALL")
def agg_path_views(spark, sf):
    return TR.sum_by(V.paths(spark, sf), "path")


@query(
    "topk_referrers",
    "SELECT referrer, CAST(sum(views) AS BIGINT) AS views FROM v_referrers GROUP BY ALL ORDER BY views DESC, referrer LIMIT 10",
)
def topk_referrers(spark, sf):
    return TR.top_keys(TR.sum_by(V.referrers(spark, sf), "referrer", by=()), "referrer")


@query(
    "topk_paths",
    "SELECT path, CAST(sum(views) AS BIGINT) AS views FROM v_paths GROUP BY ALL ORDER BY views DESC, path LIMIT 10",
)
def topk_paths(spark, sf):
    return TR.top_keys(TR.sum_by(V.paths(spark, sf), "path", by=()), "path")


def _top(name, view, months=None):
    where = f"WHERE archive_month IN (SELECT m FROM {values((m,) for m in months)} t(m))" if months else ""
    return f"""
SELECT repo, {name}, views FROM (
  SELECT repo, {name}, CAST(sum(views) AS BIGINT) AS views FROM {view} {where} GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY repo ORDER BY views DESC, {name}) <= 10"""


@query("topk_per_tenant", _top("referrer", "v_referrers"))
def topk_per_tenant(spark, sf):
    return TR.top_keys_per(TR.sum_by(V.referrers(spark, sf), "referrer"), "referrer")


# Charts


@query("chart_views_clones", f"{DAILY} ORDER BY repo, date")
def chart_views_clones(spark, sf):
    return C.views_clones(V.views(spark, sf), V.clones(spark, sf), ["2024_01"])


@query("chart_repo_stats", "SELECT repo, date, stars, forks FROM v_repo_stats ORDER BY repo, date")
def chart_repo_stats(spark, sf):
    return C.repo_stats(V.refiled_stats(spark, sf), [*ALL, "2001_09"])


@query("chart_referrers", _top("referrer", "v_referrers", ALL))
def chart_referrers(spark, sf):
    """Flagship: file the history by month, read all its months, rank referrers."""
    root = run_dir(spark, "chart")
    A.write_archive(V.referrers(spark, sf), root, "referrers", F.col("fetched_date"))
    return C.referrers(A.read_archive(spark, root, "referrers", ALL))


LAST_SIX = D.resolve_months(V.ORDERS_AS_OF, 6)
_FILED = f"""
SELECT repo, fetched_date, referrer, views, unique_visitors, archive_month FROM v_existing UNION ALL
SELECT repo, fetched_date, referrer, views, unique_visitors, '{V.ORDERS_AS_OF:%Y_%m}' FROM v_referrers
WHERE fetched_date >= DATE '{V.CUT}'"""


def _appended_twice(spark, sf, scope="all"):
    """The archive of the cut day, and the run that finds the whole history in its replies, made twice."""
    root = run_dir(spark, "archive")
    A.write_archive(V.existing(spark, sf), root, "referrers", F.col("fetched_date"))
    replies = {"referrers": V.landed_popular(spark, sf, "referrers")}
    for _ in range(2):
        P.collect_traffic(spark, root, replies, V.ORDERS_AS_OF, F.col("run_date"), scope)
    return root


@query("chart_last_months", _top("referrer", f"(SELECT DISTINCT * EXCLUDE (archive_month), archive_month FROM ({_FILED}))", LAST_SIX))
def chart_last_months(spark, sf):
    """Collect, append to the archive, and rank what was filed in the last six months; earlier months are not read."""
    root = _appended_twice(spark, sf)
    return C.referrers(A.read_archive(spark, root, "referrers", LAST_SIX))


@query(
    "archive_month_scope",
    f"""
SELECT repo, fetched_date, referrer, views, unique_visitors, archive_month FROM v_existing UNION ALL
SELECT repo, fetched_date, referrer, views, unique_visitors, '{V.ORDERS_AS_OF:%Y_%m}' FROM v_referrers r
WHERE NOT EXISTS (SELECT 1 FROM v_existing e WHERE e.archive_month = '{V.ORDERS_AS_OF:%Y_%m}' AND e.repo = r.repo
                  AND e.fetched_date = r.fetched_date AND e.referrer = r.referrer)""",
)
def archive_month_scope(spark, sf):
    """Known keys are looked for in the month of the run only, so days of earlier months are filed once more."""
    return A.read_archive(spark, _appended_twice(spark, sf, "archive_month"), "referrers")


@query(
    "chart_paths",
    f"""
SELECT *, CASE WHEN length(path) > 40 THEN '...' || right(path, 37) ELSE path END AS label
FROM ({_top("path", "v_paths", ALL)})""",
)
def chart_paths(spark, sf):
    return C.paths(V.paths(spark, sf), ALL)


# Repository digest


def _latest(kind, name):
    return f"""
SELECT repo, {name}, views, unique_visitors, row_number() OVER (PARTITION BY repo ORDER BY views DESC, {name}) - 1 AS pos
FROM v_{kind} JOIN (SELECT repo, max(fetched_date) AS fetched_date FROM v_{kind} GROUP BY ALL) USING (repo, fetched_date)"""


_MONTH = f"{V.EVENTS_AS_OF:%Y_%m}"
_BASE = "https://archive.example.org"
_LINKS = " · ".join(
    f"<{_BASE}/{k}/{k}_{_MONTH}.csv|{k.replace('_', ' ')}>" for k in ("views", "clones", "referrers", "paths", "repo_stats")
)
REPO_DIGEST = f"""
WITH info AS (
  SELECT * FROM v_repo_stats QUALIFY row_number() OVER (PARTITION BY repo ORDER BY date DESC) = 1),
totals AS ({TRAILING}),
v AS (SELECT repo, count AS vn, uniques AS vu FROM totals WHERE event_type = 'view'),
c AS (SELECT repo, count AS cn, uniques AS cu FROM totals WHERE event_type = 'click'),
head AS (
  SELECT repo, 0 AS section, 0 AS k, [
    '*GitHub Stats — {V.EVENTS_AS_OF:%b %d, %Y}*', '_<https://github.com/' || repo || '|' || repo || '>_', '',
    '*Repository Overview*', format('• Stars: *{{:,}}*', stars), format('• Forks: *{{:,}}*', forks),
    format('• Watchers: *{{:,}}*', watchers), format('• Open Issues: *{{:,}}*', open_issues), '',
    '*Traffic — Last 14 Days*',
    format('• Page Views: *{{:,}}* ({{:,}} unique)', coalesce(vn, 0), coalesce(vu, 0)),
    format('• Git Clones: *{{:,}}* ({{:,}} unique)', coalesce(cn, 0), coalesce(cu, 0))] AS lines
  FROM info LEFT JOIN v USING (repo) LEFT JOIN c USING (repo)),
refs AS (
  SELECT repo, 1 AS section, pos AS k,
         CASE WHEN pos = 0 THEN ['', '*Top Referrers*'] ELSE CAST([] AS VARCHAR[]) END
         || [format('• {{}}: {{:,}} views ({{:,}} unique)', referrer, views, unique_visitors)] AS lines
  FROM ({_latest("referrers", "referrer")})),
ways AS (
  SELECT repo, 2 AS section, pos AS k,
         CASE WHEN pos = 0 THEN ['', '*Top Paths*'] ELSE CAST([] AS VARCHAR[]) END
         || [format('• `{{}}`: {{:,}} views ({{:,}} unique)', path, views, unique_visitors)] AS lines
  FROM ({_latest("paths", "path")})),
foot AS (SELECT repo, 3 AS section, 0 AS k, ['', '*CSV Archive ({_MONTH})*', '{_LINKS}'] AS lines FROM info),
lined AS (
  SELECT repo, section, k, unnest(lines) AS line, generate_subscripts(lines, 1) AS part
  FROM (SELECT * FROM head UNION ALL SELECT * FROM refs UNION ALL SELECT * FROM ways UNION ALL SELECT * FROM foot))
SELECT repo, row_number() OVER (PARTITION BY repo ORDER BY section, k, part) AS line_no, line FROM lined"""


def repo_digest_lines(spark, sf):
    """Digest of every repository at its latest replies."""

    def latest(df, day="run_date"):
        return K.first_per_key(df, ["repo"], [F.desc(day)])

    info = L.read_repo_info(latest(V.landed_info(spark, sf)), F.col("run_date"))
    entries = {
        kind: L.read_popular(latest(V.landed_popular(spark, sf, kind)), kind, F.col("run_date"))
        for kind in ("referrers", "paths")
    }
    totals = TR.trailing_totals(V.events(spark, sf), ["repo", "event_type"], V.EVENTS_AS_OF)
    return G.repo_digest(
        info,
        totals.where("event_type = 'view'").drop("event_type"),
        totals.where("event_type = 'click'").drop("event_type"),
        entries["referrers"],
        entries["paths"],
        V.EVENTS_AS_OF,
        _BASE,
    )


@query("digest_repo", REPO_DIGEST)
def digest_repo(spark, sf):
    return repo_digest_lines(spark, sf)


@query(
    "agg_lines",
    f"""
SELECT repo, (line_no - 1) // 8 + 1 AS part, string_agg(line, chr(10) ORDER BY line_no) AS message
FROM ({REPO_DIGEST}) GROUP BY ALL""",
)
def agg_lines(spark, sf):
    return G.messages(repo_digest_lines(spark, sf), ["repo"], size=8)


@query(
    "digest_payload",
    f"""
SELECT repo, 1 AS part, 'stats' AS channel, string_agg(line, chr(10) ORDER BY line_no) AS text, true AS mrkdwn
FROM ({REPO_DIGEST}) GROUP BY repo""",
)
def digest_payload(spark, sf):
    path = run_dir(spark, "payload")
    text = G.messages(repo_digest_lines(spark, sf), ["repo"])
    G.write_digest(G.digest_payload(text, ["repo"], "stats"), path)
    written = spark.read.schema("repo STRING, part BIGINT, payload STRING").json(path)
    body = F.from_json("payload", "channel STRING, text STRING, mrkdwn BOOLEAN")
    return written.select("repo", "part", body.alias("body")).select("repo", "part", "body.*")
