"""The inputs of :mod:`outpulse.catalog.views` in DuckDB SQL, in dependency order."""

from __future__ import annotations

from outpulse.catalog import views as V
from outpulse.functions.text import WHITESPACE

WS = "||".join(f"chr({ord(c)})" for c in WHITESPACE)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows) -> str:
    """VALUES list of tuples of ints and texts."""
    shown = lambda x: quoted(x) if isinstance(x, str) else str(x)
    return "(VALUES " + ", ".join("(" + ", ".join(shown(x) for x in row) + ")" for row in rows) + ")"


def sessionized(gap: int) -> str:
    """Hits with the attributes of their session, by plain row windows."""
    return f"""
SELECT h.*, s.session_start, s.session_hits, s.session_seconds, s.session_source, s.session_medium,
       min(h.ts) OVER (PARTITION BY h.property_id, h.user_id) AS user_first_ts
FROM v_numbered_{gap} h JOIN (
  SELECT property_id, user_id, session_no, min(ts) AS session_start, count(*) AS session_hits,
         date_diff('second', min(ts), max(ts)) AS session_seconds,
         first(source ORDER BY ts, event_id) AS session_source,
         first(medium ORDER BY ts, event_id) AS session_medium
  FROM v_numbered_{gap} GROUP BY ALL) s USING (property_id, user_id, session_no)"""


def numbered(gap: int) -> str:
    return f"""
SELECT * EXCLUDE (previous), sum(CASE WHEN previous IS NULL OR ts > previous + INTERVAL '{gap} seconds' THEN 1 ELSE 0 END)
       OVER (PARTITION BY property_id, user_id ORDER BY ts, event_id) AS session_no
FROM (SELECT *, lag(ts) OVER (PARTITION BY property_id, user_id ORDER BY ts, event_id) AS previous FROM v_hits)"""


def popular(name: str, value: str) -> str:
    return f"""
SELECT 'org/r' || (o_orderkey % 5) AS repo, CAST(o_orderdate AS DATE) AS fetched_date, {value} AS {name},
       count(*) AS views, count(DISTINCT o_custkey) AS unique_visitors,
       strftime(CAST(o_orderdate AS DATE), '%Y_%m') AS archive_month
FROM orders GROUP BY ALL"""


def daily(kind: str, event: str, uniques: str) -> str:
    return f"""
SELECT 'org/r' || (user_id % 3) AS repo, CAST(ts AS DATE) AS date, count(*) AS {kind},
       count(DISTINCT user_id) AS {uniques}, strftime(CAST(ts AS DATE), '%Y_%m') AS archive_month
FROM events WHERE event_type = '{event}' GROUP BY ALL"""


def summary(text: str, fallback: str = "''") -> str:
    return f"nullif(trim(left(coalesce(nullif({text}, ''), {fallback}, ''), 200), {WS}), '')"


VIEWS: dict[str, str] = {
    "v_keywords": f"SELECT * FROM {values(enumerate(V.KEYWORDS, 1))} k(kw_rank, keyword)",
    "v_views": daily("views", "view", "unique_visitors"),
    "v_clones": daily("clones", "click", "unique_cloners"),
    "v_referrers": popular("referrer", "'ref' || (o_custkey % 40)"),
    "v_paths": popular("path", "'/docs/' || o_orderpriority || '/a-rather-long-section-name/' || (o_custkey % 60)"),
    "v_repo_stats": """
SELECT repo, date, CAST(sum(n) OVER (PARTITION BY repo ORDER BY date) AS BIGINT) AS stars,
       CAST(sum(f) OVER (PARTITION BY repo ORDER BY date) AS BIGINT) AS forks, n AS watchers, f AS open_issues,
       strftime(date, '%Y_%m') AS archive_month
FROM (SELECT 'org/r' || (o_orderkey % 5) AS repo, CAST(o_orderdate AS DATE) AS date, count(*) AS n,
             count(*) FILTER (WHERE o_orderstatus = 'F') AS f FROM orders GROUP BY ALL)""",
    "v_existing": f"SELECT * FROM v_referrers WHERE fetched_date < DATE '{V.CUT}'",
    "v_incoming": """
SELECT * EXCLUDE (archive_month) REPLACE (views + 100 AS views), 1 AS _seq FROM v_referrers UNION ALL
SELECT * EXCLUDE (archive_month) REPLACE (views + 200 AS views), 2 AS _seq FROM v_referrers""",
    "v_hits": """
SELECT 'p' || (user_id % 3) AS property_id, event_id, user_id, ts, event_type, '/p/' || (k % 20) AS page_path,
       CASE WHEN k % 20 % 7 = 0 THEN '(not set)' ELSE 'Page ' || (k % 20) END AS page_title,
       'src' || (event_id % 6) AS source,
       CASE event_id % 3 WHEN 0 THEN 'organic' WHEN 1 THEN 'referral' ELSE '(none)' END AS medium,
       coalesce(n_name, '(not set)') AS country,
       CASE event_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'tablet' ELSE 'desktop' END AS device_category
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)
LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "v_numbered_1800": numbered(1800),
    "v_sessioned_1800": sessionized(1800),
    "v_numbered_21600": numbered(21600),
    "v_sessioned_21600": sessionized(21600),
    "v_posts": f"""
SELECT 'm' || (doc_id % 3) AS monitor, kw_rank, keyword, doc_id AS hit_rank,
       {V.EVENTS_AS_OF_SECONDS} - (doc_id * 3571) % 259200 AS created_utc, 'Post ' || doc_id || ' in ' || source AS title,
       '/r/' || source || '/comments/' || md5(text) AS permalink, text AS selftext,
       'https://ex.org/d/' || doc_id AS url, 'r/' || source AS subreddit_name_prefixed, n_chars % 100 AS score
FROM documents JOIN v_keywords ON contains(lower(text), keyword)""",
    "v_comment_hits": f"""
SELECT 'm' || (conv_id % 3) AS monitor, kw_rank, keyword, conv_id * 1000 + turn AS hit_rank,
       {V.EVENTS_AS_OF_SECONDS} - (conv_id * 7919 + turn * 613) % 259200 AS created_utc,
       '/r/' || role || '/comments/' || conv_id || '/' || turn AS permalink, text AS body, role AS subreddit,
       length(text) % 50 AS score
FROM conversations JOIN v_keywords ON contains(lower(text), keyword)""",
    "v_web": """
SELECT 'm' || (page_id % 3) AS monitor, kw_rank, keyword, page_id AS hit_rank, 'Page ' || page_id AS title,
       CASE WHEN url LIKE '%#top' THEN NULL WHEN url LIKE '%.html' THEN '' ELSE url END AS url,
       CASE WHEN contains(url, 'example.com') THEN 'GitHub' WHEN contains(url, 'example.net') THEN 'Blog'
            WHEN contains(url, 'example.org') THEN 'Forum' END AS source,
       html AS summary,
       CASE WHEN contains(url, '/en/') THEN 'positive' WHEN contains(url, '/de/') THEN 'negative'
            WHEN contains(url, '/fr/') THEN 'neutral' END AS sentiment,
       DATE '2024-01-30' AS date
FROM pages JOIN v_keywords ON contains(lower(html), keyword)""",
    "v_post_mentions": f"""
SELECT monitor, kw_rank, keyword, 1 AS src_rank, hit_rank, created_utc, title, 'https://reddit.com' || permalink AS url,
       'Reddit' AS source, {summary("selftext", "url")} AS summary, 'neutral' AS sentiment,
       CAST(to_timestamp(created_utc) AT TIME ZONE 'UTC' AS DATE) AS date, subreddit_name_prefixed AS subreddit, score
FROM v_posts""",
    "v_comment_mentions": f"""
SELECT monitor, kw_rank, keyword, 2 AS src_rank, hit_rank, created_utc, 'Comment in r/' || subreddit AS title,
       'https://reddit.com' || permalink AS url, 'Reddit' AS source, {summary("body")} AS summary,
       'neutral' AS sentiment, CAST(to_timestamp(created_utc) AT TIME ZONE 'UTC' AS DATE) AS date,
       'r/' || subreddit AS subreddit, score
FROM v_comment_hits""",
    "v_web_mentions": """
SELECT monitor, kw_rank, keyword, 3 AS src_rank, hit_rank, CAST(NULL AS BIGINT) AS created_utc, title, url, source,
       summary, sentiment, date, CAST(NULL AS VARCHAR) AS subreddit, CAST(NULL AS BIGINT) AS score
FROM v_web""",
    "v_mentions": """
SELECT * EXCLUDE (created_utc) FROM (SELECT * FROM v_post_mentions UNION ALL SELECT * FROM v_comment_mentions
                                     UNION ALL SELECT * FROM v_web_mentions)""",
    "v_unique_mentions": """
SELECT * FROM v_mentions WHERE url <> ''
QUALIFY row_number() OVER (PARTITION BY monitor, url ORDER BY kw_rank, src_rank, hit_rank) = 1""",
    "v_search": """
SELECT regexp_extract(url, 'example\\.([a-z]+)', 1) AS campaign,
       'topic ' || (page_id % 75 // 5 + 1) || '-' || (page_id % 75 % 5) AS keyword, page_id AS hit_pos,
       replace(replace(url, '.example.', '.reddit.com/r/'), '/en/', '/comments/') AS link,
       ' Page ' || page_id || CASE WHEN contains(url, '/en/') THEN ' - Reddit ' ELSE ' ' END AS title, html AS snippet
FROM pages""",
    "v_based": """
SELECT *, rtrim(split_part(link, '?', 1), '/') AS url FROM v_search""",
    "v_batches": "SELECT * FROM "
    + values((b, p, w) for b, words in V.BATCHES.items() for p, w in enumerate(words))
    + " b(batch_no, kw_pos, keyword)",
    "v_cursors": "SELECT campaign, CAST(count(*) % 15 + 1 AS INTEGER) AS next_batch FROM v_search GROUP BY ALL",
    "v_seen": f"""
SELECT campaign, rtrim(split_part(link, '?', 1), '/') AS url, title, DATE '{V.EVENTS_AS_OF}' AS date_seen
FROM v_search WHERE contains(link, '?')""",
    "v_comments": """
SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 't1' ELSE 'more' END AS kind,
       CASE WHEN (conv_id + turn) % 10 = 0 THEN '[deleted]' ELSE text END AS body FROM conversations""",
    "v_thread_comments": f"""
SELECT conv_id, turn // 10 AS page,
       list(trim(body, {WS}) ORDER BY turn) FILTER (WHERE kind = 't1'
            AND trim(body, {WS}) NOT IN ('', '[removed]', '[deleted]'))[1:5] AS comments
FROM v_comments GROUP BY ALL""",
    "v_threads": """
SELECT conv_id, page, CASE WHEN conv_id % 7 = 0 THEN '[removed]' ELSE 'Thread ' || conv_id || ' on things' END AS selftext,
       coalesce(comments, []) AS comments
FROM v_thread_comments""",
    "v_candidates": f"""
WITH run AS (
  SELECT campaign, i AS batch_pos, (next_batch - 1 + i) % 15 + 1 AS batch_no
  FROM v_cursors, unnest(range(15)) r(i)),
searched AS (SELECT campaign, batch_pos, batch_no, kw_pos, keyword FROM run JOIN v_batches USING (batch_no)),
first AS (
  SELECT s.*, hit_pos, link, title, snippet FROM searched s JOIN v_search USING (campaign, keyword)
  QUALIFY row_number() OVER (PARTITION BY campaign, batch_pos, kw_pos ORDER BY hit_pos) <= 3),
posts AS (
  SELECT campaign, batch_pos, batch_no, kw_pos, keyword, hit_pos, rtrim(split_part(link, '?', 1), '/') AS url,
         split_part(split_part(link, '/r/', 2), '/', 1) AS subreddit,
         trim(replace(title, ' - Reddit', ''), {WS}) AS title, snippet
  FROM first WHERE contains(link, 'reddit.com/r/') AND contains(link, '/comments/')),
fresh AS (
  SELECT * FROM (SELECT * FROM posts
    QUALIFY row_number() OVER (PARTITION BY campaign, url ORDER BY batch_pos, kw_pos, hit_pos) = 1)
  WHERE (campaign, url) NOT IN (SELECT (campaign, url) FROM v_seen)),
fetched AS (
  SELECT b.url, t.selftext, t.comments FROM v_threads t JOIN v_based b ON b.hit_pos = t.conv_id
  QUALIFY row_number() OVER (PARTITION BY b.url ORDER BY page) = 1)
SELECT f.*, CASE WHEN t.selftext IS NULL THEN snippet
                 WHEN t.selftext IN ('', '[removed]', '[deleted]') THEN left(snippet, 2000)
                 ELSE left(t.selftext, 2000) END AS body, coalesce(t.comments, []) AS comments
FROM fresh f LEFT JOIN fetched t USING (url)""",
    "v_prompts": """
SELECT *, subreddit || chr(10) || title || chr(10) || CASE WHEN body = '' THEN '(no body text)' ELSE body END || chr(10)
       || CASE WHEN len(comments) = 0 THEN '(no comments)' ELSE '- ' || array_to_string(comments, chr(10) || '- ') END
       AS prompt
FROM v_candidates""",
    "v_scored": """
SELECT * EXCLUDE (n), CAST(n AS DOUBLE) AS relevance_score,
       CASE WHEN n = 7 THEN '' ELSE 'found ' || n END AS suggested_comment
FROM (SELECT *, least(10, """
    + " + ".join(f"CAST(contains(lower(prompt), {quoted(p)}) AS INTEGER)" for p in V.SCORED_PHRASES)
    + """) AS n FROM v_prompts)
WHERE n > 2""",
    "v_opportunities": """
SELECT * FROM v_scored WHERE relevance_score >= 6 AND suggested_comment <> ''
QUALIFY row_number() OVER (PARTITION BY campaign ORDER BY batch_pos, kw_pos, hit_pos) <= 10""",
}
