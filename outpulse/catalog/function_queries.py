"""Queries over scalar functions, each applied to every row of a given table."""

from __future__ import annotations

from pyspark.sql import functions as F

from outpulse.catalog import views as V
from outpulse.catalog.registry import query
from outpulse.catalog.sqlviews import WS, summary
from outpulse.functions import dates as D
from outpulse.functions import text as X

def _day():
    return F.col("o_orderdate").cast("date")



@query("fn_iso_date", "SELECT event_id, CAST(ts AS DATE) AS date FROM events")
def fn_iso_date(spark, sf):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return V.table(spark, sf, "events").select("event_id", D.iso_date(stamp).alias("date"))


@query(
    "fn_epoch_date",
    "SELECT o_orderkey, CAST(to_timestamp(o_orderkey * 97031 - 500000) AT TIME ZONE 'UTC' AS DATE) AS date FROM orders",
)
def fn_epoch_date(spark, sf):
    seconds = F.col("o_orderkey") * 97_031 - 500_000
    return V.table(spark, sf, "orders").select("o_orderkey", D.epoch_date(seconds).alias("date"))


@query("fn_archive_name", "SELECT o_orderkey, 'views_' || strftime(o_orderdate, '%Y_%m') AS name FROM orders")
def fn_archive_name(spark, sf):
    return V.table(spark, sf, "orders").select("o_orderkey", D.archive_name("views", _day()).alias("name"))


@query(
    "fn_last_months",
    """
SELECT o_orderkey, array_to_string(CASE WHEN n = 0 THEN [strftime(d, '%Y_%m')] ELSE
         list_transform(range(n), lambda i: strftime(date_trunc('month', d) - to_months(CAST(n - 1 - i AS INTEGER)), '%Y_%m'))
       END, ',') AS months
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_custkey % 15 AS n FROM orders)""",
)
def fn_last_months(spark, sf):
    count = (F.col("o_custkey") % 15).cast("int")
    months = F.array_join(D.last_months(_day(), count), ",")
    return V.table(spark, sf, "orders").select("o_orderkey", months.alias("months"))


RANGE = "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_custkey % 9 + 1 AS INTEGER) AS n FROM orders)"


@query(
    "fn_report_range",
    f"SELECT o_orderkey, d - n AS first_day, d - 1 AS last_day, d AS today FROM {RANGE}",
)
def fn_report_range(spark, sf):
    days = (F.col("o_custkey") % 9 + 1).cast("int")
    first, last = D.report_range(_day(), "yesterday", days)
    return V.table(spark, sf, "orders").select(
        "o_orderkey", first.alias("first_day"), last.alias("last_day"), D.report_range(_day(), "today")[0].alias("today")
    )


@query(
    "fn_range_label",
    f"""
SELECT o_orderkey, CASE WHEN n = 1 THEN strftime(d - 1, '%b %d, %Y')
                        ELSE strftime(d - n, '%b %d') || ' – ' || strftime(d - 1, '%b %d, %Y') END AS label,
       strftime(d, '%b %d, %Y') || ' (so far)' AS today_label, '2024-01-05' AS literal_label FROM {RANGE}""",
)
def fn_range_label(spark, sf):
    days = (F.col("o_custkey") % 9 + 1).cast("int")
    return V.table(spark, sf, "orders").select(
        "o_orderkey",
        D.range_label(_day(), "yesterday", days).alias("label"),
        D.range_label(_day(), "today").alias("today_label"),
        D.range_label(_day(), "2024-01-05").alias("literal_label"),
    )


@query(
    "fn_duration",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN event_type ELSE
  CAST(CAST(trunc(value * 31.7) AS BIGINT) // 60 AS VARCHAR) || 'm ' || CAST(trunc(value * 31.7) AS BIGINT) % 60 || 's'
END AS shown FROM events""",
)
def fn_duration(spark, sf):
    seconds = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(
        (F.col("value") * F.lit(31.7)).cast("string")
    )
    return V.table(spark, sf, "events").select("event_id", X.duration(seconds).alias("shown"))


@query(
    "fn_percent",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN event_type ELSE printf('%.1f%%', value / 100 * 100) END AS shown,
       printf('%.1f%%', value / 8 * 100) AS eighths FROM events""",
)
def fn_percent(spark, sf):
    fraction = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(
        (F.col("value") / 100).cast("string")
    )
    return V.table(spark, sf, "events").select(
        "event_id", X.percent(fraction).alias("shown"), X.percent(F.col("value") / 8).alias("eighths")
    )


@query("fn_thousands", "SELECT l_orderkey, l_linenumber, format('{:,}', l_orderkey * 104729 - 5000) AS shown FROM lineitem")
def fn_thousands(spark, sf):
    shown = X.thousands(F.col("l_orderkey") * 104_729 - 5000)
    return V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", shown.alias("shown"))


@query(
    "fn_plural",
    "SELECT o_custkey, count(*) || ' order' || CASE WHEN count(*) <> 1 THEN 's' ELSE '' END AS shown FROM orders GROUP BY ALL",
)
def fn_plural(spark, sf):
    n = F.col("n")
    counts = V.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return counts.select("o_custkey", F.concat(n.cast("string"), F.lit(" order"), X.plural(n)).alias("shown"))


@query("fn_url_base", "SELECT page_id, rtrim(split_part(url, '?', 1), '/') AS base FROM pages")
def fn_url_base(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", X.url_base(F.col("url")).alias("base"))


@query(
    "fn_url_segment",
    """
SELECT page_id, split_part(split_part(link, '/r/', 2), '/', 1) AS forum, split_part(split_part(url, '/en/', 2), '/', 1) AS item
FROM pages JOIN (SELECT hit_pos AS page_id, link FROM v_search) USING (page_id)""",
)
def fn_url_segment(spark, sf):
    link = F.replace("url", F.lit(".example."), F.lit(".reddit.com/r/"))
    return V.table(spark, sf, "pages").select(
        "page_id", X.url_segment(link).alias("forum"), X.url_segment(F.col("url"), "/en/").alias("item")
    )


@query("fn_title_clean", f"SELECT hit_pos, trim(replace(title, ' - Reddit', ''), {WS}) AS title FROM v_search")
def fn_title_clean(spark, sf):
    return V.search_hits(spark, sf).select("hit_pos", X.title_clean(F.col("title")).alias("title"))


@query(
    "fn_summary",
    f"SELECT doc_id, {summary('''CASE WHEN lang = 'es' THEN '' ELSE text END''', 'source')} AS summary FROM documents",
)
def fn_summary(spark, sf):
    text = F.when(F.col("lang") == "es", F.lit("")).otherwise(F.col("text"))
    return V.table(spark, sf, "documents").select("doc_id", X.summary(text, F.col("source")).alias("summary"))


@query(
    "fn_snippet",
    "SELECT doc_id, CASE WHEN length(text) > 140 THEN left(text, 140) || '...' ELSE text END AS snippet FROM documents",
)
def fn_snippet(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", X.snippet(F.col("text")).alias("snippet"))


@query(
    "fn_label_tail",
    "SELECT DISTINCT path, CASE WHEN length(path) > 40 THEN '...' || right(path, 37) ELSE path END AS label FROM v_paths",
)
def fn_label_tail(spark, sf):
    return V.paths(spark, sf).select("path").distinct().withColumn("label", X.label_tail(F.col("path")))


@query(
    "fn_title_fallback",
    "SELECT event_id, CASE WHEN page_title = '(not set)' THEN page_path ELSE page_title END AS title FROM v_hits",
)
def fn_title_fallback(spark, sf):
    title = X.title_fallback(F.col("page_title"), F.col("page_path"))
    return V.hits(spark, sf).select("event_id", title.alias("title"))


@query("fn_strip_fence", f"SELECT doc_id, md5(trim(text, {WS})) AS content FROM documents")
def fn_strip_fence(spark, sf):
    """Fenced, tagged and bare forms of the same text all give the text back."""
    text, fence = F.col("text"), F.lit("```")
    wrapped = (
        F.when(F.col("lang") == "de", F.concat(F.lit(" \n"), fence, F.lit("json\n"), text, F.lit("\n"), fence))
        .when(F.col("lang") == "fr", F.concat(fence, F.lit("\n"), text, fence, F.lit(" trailing words")))
        .otherwise(F.concat(F.lit("\t"), text, F.lit("\n")))
    )
    return V.table(spark, sf, "documents").select("doc_id", F.md5(X.strip_fence(wrapped)).alias("content"))


@query(
    "fn_ws_trim",
    f"""
SELECT doc_id, md5(trimmed) AS trimmed, length(trimmed) AS n
FROM (SELECT doc_id, trim(chr(160) || chr(9) || text || chr(8195) || chr(10), {WS}) AS trimmed FROM documents)""",
)
def fn_ws_trim(spark, sf):
    trimmed = X.ws_trim(F.concat(F.lit("\xa0\t"), F.col("text"), F.lit(" \n")))
    return V.table(spark, sf, "documents").select(
        "doc_id", F.md5(trimmed).alias("trimmed"), F.length(trimmed).cast("bigint").alias("n")
    )


@query("fn_lower", "SELECT doc_id, md5(lower(text)) AS folded FROM documents")
def fn_lower(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", F.md5(X.folded(F.col("text"))).alias("folded"))
