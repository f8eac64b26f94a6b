"""Queries over web hits: sessions, reports, the web digest."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from outpulse.catalog import views as V
from outpulse.catalog.registry import query
from outpulse.operators import web as W
from outpulse.plans import digests as G
from outpulse.session import run_dir
from outpulse.sources.firsts import update_firsts

WIDE = 21_600
WEEK = (date(2024, 1, 8), date(2024, 1, 14))
LATER = (date(2024, 1, 8), date(2024, 1, 30))


def _inside(column, days):
    start, end = days
    return f"({column} >= DATE '{start}' AND {column} < DATE '{end}' + INTERVAL 1 DAY)"


def report_sql(dims, metrics, days, order=None, limit=10, gap=W.GAP):
    """Report by distinct counts over hits; ``dims`` maps names to columns."""
    names = "".join(f', "{d}"' for d in dims)
    columns = "".join(f', {c} AS "{d}"' for d, c in dims.items())
    inside, begun = _inside("ts", days), _inside("session_start", days)
    new = _inside("user_first_ts", days)
    shown = {
        "sessions": "sessions",
        "totalUsers": '"totalUsers"',
        "newUsers": '"newUsers"',
        "screenPageViews": '"screenPageViews"',
        "bounceRate": "CASE WHEN sessions = 0 THEN 0.0::DOUBLE ELSE bounced::DOUBLE / sessions END AS \"bounceRate\"",
        "averageSessionDuration": "CASE WHEN sessions = 0 THEN 0.0::DOUBLE ELSE seconds::DOUBLE / sessions END"
        ' AS "averageSessionDuration"',
    }
    ordering = ", ".join([f'"{order}" DESC'] * bool(order) + [f'a."{d}"' for d in dims]) or "a.property_id"
    joined = " AND ".join(["a.property_id = b.property_id", *[f'a."{d}" = b."{d}"' for d in dims]])
    return f"""
WITH x AS (SELECT *{columns}, {inside} AS inside, {begun} AS begun, {new} AS fresh FROM v_sessioned_{gap}),
a AS (
  SELECT property_id{names}, count(DISTINCT user_id) FILTER (WHERE inside) AS "totalUsers",
         count(DISTINCT user_id) FILTER (WHERE inside AND fresh) AS "newUsers",
         count(*) FILTER (WHERE inside AND event_type = 'view') AS "screenPageViews", count(*) FILTER (WHERE inside OR begun) AS rows
  FROM x GROUP BY ALL),
b AS (
  SELECT property_id{names}, count(*) FILTER (WHERE begun) AS sessions,
         count(*) FILTER (WHERE begun AND session_hits = 1) AS bounced,
         coalesce(sum(session_seconds) FILTER (WHERE begun), 0) AS seconds
  FROM (SELECT DISTINCT property_id, user_id, session_no, session_hits, session_seconds, begun{names} FROM x)
  GROUP BY ALL)
SELECT a.property_id{"".join(f', a."{d}"' for d in dims)}, {", ".join(shown[m] for m in metrics)}
FROM a JOIN b ON {joined} WHERE {"rows > 0" if dims else "true"}
QUALIFY row_number() OVER (PARTITION BY a.property_id ORDER BY {ordering}) <= {limit}"""


OVERVIEW = ["sessions", "totalUsers", "newUsers", "screenPageViews", "bounceRate", "averageSessionDuration"]
PAGE = {"pagePath": "page_path", "pageTitle": "page_title"}
SOURCE = {"sessionSource": "session_source", "sessionMedium": "session_medium"}


@query(
    "filt_date_range",
    f"SELECT property_id, event_id, user_id, ts, event_type FROM v_hits WHERE {_inside('ts', WEEK)}",
)
def filt_date_range(spark, sf):
    hits = V.hits(spark, sf).select("property_id", "event_id", "user_id", "ts", "event_type")
    return hits.where(W.in_range(F.col("ts"), *WEEK))


@query(
    "win_sessions",
    f"""
SELECT DISTINCT property_id, user_id, session_start, session_hits, session_seconds, session_source, session_medium,
       user_first_ts FROM v_sessioned_{WIDE}""",
)
def win_sessions(spark, sf):
    return W.sessions(V.hits(spark, sf), WIDE)


@query(
    "win_session_hits",
    """
SELECT property_id, event_id, user_id, ts, session_start, session_hits, session_seconds, session_source, session_medium
FROM v_sessioned_1800""",
)
def win_session_hits(spark, sf):
    return W.with_sessions(V.hits(spark, sf)).select(
        "property_id", "event_id", "user_id", "ts", "session_start", "session_hits", "session_seconds",
        "session_source", "session_medium",
    )


@query("ga_overview", report_sql({}, OVERVIEW, LATER, gap=WIDE))
def ga_overview(spark, sf):
    hits = V.hits(spark, sf)
    firsts = update_firsts(spark, run_dir(spark, "firsts"), hits, LATER[1])
    return W.overview(hits, LATER, gap=WIDE, firsts=firsts)


@query(
    "first_hits",
    f"SELECT property_id, user_id, min(ts) AS first_ts FROM v_hits WHERE {_inside('ts', (date(1970, 1, 1), LATER[1]))} GROUP BY ALL",
)
def first_hits(spark, sf):
    """Filed in three runs; each reads the days since the one before, and one is repeated."""
    hits, path = V.hits(spark, sf), run_dir(spark, "firsts")
    for through in (WEEK[0], WEEK[1], WEEK[1], LATER[1]):
        firsts = update_firsts(spark, path, hits, through)
    return firsts


@query(
    "ga_report_generic",
    report_sql(
        {"deviceCategory": "device_category", **SOURCE}, ["newUsers", "bounceRate", "screenPageViews", "averageSessionDuration"],
        WEEK, "screenPageViews", 25, WIDE,
    ),
)
def ga_report_generic(spark, sf):
    return W.report(
        V.hits(spark, sf),
        ["deviceCategory", "sessionSource", "sessionMedium"],
        ["newUsers", "bounceRate", "screenPageViews", "averageSessionDuration"],
        WEEK,
        [("screenPageViews", True)],
        limit=25,
        gap=WIDE,
    )


@query("ga_top_pages", report_sql(PAGE, ["screenPageViews", "totalUsers"], V.EVENTS_RANGE, "screenPageViews"))
def ga_top_pages(spark, sf):
    return W.top_pages(V.hits(spark, sf), V.EVENTS_RANGE)


@query("ga_top_sources", report_sql(SOURCE, ["sessions", "totalUsers"], V.EVENTS_RANGE, "sessions"))
def ga_top_sources(spark, sf):
    return W.top_sources(V.hits(spark, sf), V.EVENTS_RANGE)


@query("ga_top_countries", report_sql({"country": "country"}, ["sessions", "totalUsers"], V.EVENTS_RANGE, "sessions", 5))
def ga_top_countries(spark, sf):
    return W.top_countries(V.hits(spark, sf), V.EVENTS_RANGE)


@query("ga_devices", report_sql({"deviceCategory": "device_category"}, ["sessions"], V.EVENTS_RANGE))
def ga_devices(spark, sf):
    return W.devices(V.hits(spark, sf), V.EVENTS_RANGE)


def _listed(name, section, heading, report, order, line):
    return f"""
{name} AS (
  SELECT property_id, {section} AS section, k,
         CASE WHEN k = 1 THEN ['', '*{heading}*'] ELSE CAST([] AS VARCHAR[]) END || [{line}] AS lines
  FROM (SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY {order}) AS k FROM ({report})))"""


_USERS = "{}: {:,} sessions ({:,} users)"
_SOURCE_NAME = "\"sessionSource\" || ' / ' || \"sessionMedium\""
_PAGE_NAME = 'CASE WHEN "pageTitle" = \'(not set)\' THEN "pagePath" ELSE "pageTitle" END'
WEB_DIGEST = f"""
WITH head AS (
  SELECT property_id, 0 AS section, 0 AS k, [
    '*Google Analytics — a label*', '_Property ID: ' || property_id || '_', '', '*Overview*',
    format('• Sessions: *{{:,}}*', sessions), format('• Total Users: *{{:,}}*', "totalUsers"),
    format('• New Users: *{{:,}}*', "newUsers"), format('• Page Views: *{{:,}}*', "screenPageViews"),
    printf('• Bounce Rate: *%.1f%%*', "bounceRate" * 100),
    format('• Avg Session Duration: *{{}}m {{}}s*', CAST(trunc("averageSessionDuration") AS BIGINT) // 60,
           CAST(trunc("averageSessionDuration") AS BIGINT) % 60)] AS lines
  FROM ({report_sql({}, OVERVIEW, V.EVENTS_RANGE, gap=WIDE)})),
dev AS (
  SELECT property_id, 1 AS section, 0 AS k,
         ['', '*Devices*  ' || string_agg(format('{{}}: {{:,}}', "deviceCategory", sessions), ' · ' ORDER BY "deviceCategory")]
         AS lines
  FROM ({report_sql({"deviceCategory": "device_category"}, ["sessions"], V.EVENTS_RANGE, gap=WIDE)}) GROUP BY property_id),
{_listed("src", 2, "Top Traffic Sources", report_sql(SOURCE, ["sessions", "totalUsers"], V.EVENTS_RANGE, "sessions", gap=WIDE),
         'sessions DESC, "sessionSource", "sessionMedium"', f"format('• {_USERS}', {_SOURCE_NAME}, sessions, " + '"totalUsers")')},
{_listed("pag", 3, "Top Pages", report_sql(PAGE, ["screenPageViews", "totalUsers"], V.EVENTS_RANGE, "screenPageViews", gap=WIDE),
         '"screenPageViews" DESC, "pagePath", "pageTitle"',
         f"format('• `{{}}` — {{}}: {{:,}} views', " + f'"pagePath", {_PAGE_NAME}, "screenPageViews")')},
{_listed("cou", 4, "Top Countries", report_sql({"country": "country"}, ["sessions", "totalUsers"], V.EVENTS_RANGE, "sessions", 5, WIDE),
         "sessions DESC, country", f"format('• {_USERS}', country, sessions, " + '"totalUsers")')},
lined AS (
  SELECT property_id, section, k, unnest(lines) AS line, generate_subscripts(lines, 1) AS part
  FROM (SELECT * FROM head UNION ALL SELECT * FROM dev UNION ALL SELECT * FROM src UNION ALL SELECT * FROM pag
        UNION ALL SELECT * FROM cou))
SELECT property_id, row_number() OVER (PARTITION BY property_id ORDER BY section, k, part) AS line_no, line FROM lined"""


@query("digest_ga", WEB_DIGEST)
def digest_ga(spark, sf):
    return G.web_digest(V.hits(spark, sf), V.EVENTS_RANGE, "a label", gap=WIDE)
