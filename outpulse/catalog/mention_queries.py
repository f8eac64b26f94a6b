"""Queries over mentions: listings, replies, filters, dedupe, counts, the mention digest."""

from __future__ import annotations

from pyspark.sql import functions as F

from outpulse.catalog import views as V
from outpulse.catalog.registry import query
from outpulse.catalog.sqlviews import WS, quoted, values
from outpulse.functions import text as X
from outpulse.operators import mentions as M
from outpulse.plans import collect as P
from outpulse.plans import digests as G
from outpulse.sources import landing as L

KEEP = ("monitor", "kw_rank", "keyword")
CUTOFF = V.EVENTS_AS_OF_SECONDS - 86_400
MENTION = "monitor, kw_rank, keyword, title, url, source, summary, sentiment, date, subreddit, score"


def without(text, phrases=V.EXCLUDED):
    return " AND ".join(f"NOT contains({text}, {quoted(p)})" for p in phrases)


@query("src_listing_posts", f"SELECT {MENTION}, created_utc::DOUBLE AS created_utc FROM v_post_mentions")
def src_listing_posts(spark, sf):
    return L.read_listing(V.landed_posts(spark, sf), "post", keep=KEEP).drop("pos")


@query("src_listing_comments", f"SELECT {MENTION}, created_utc::DOUBLE AS created_utc FROM v_comment_mentions")
def src_listing_comments(spark, sf):
    return L.read_listing(V.landed_comments(spark, sf), "comment", keep=KEEP).drop("pos")


@query(
    "src_reply_array",
    "SELECT monitor, kw_rank, keyword, title, url, source, summary, sentiment, date, CAST(date AS VARCHAR) AS date_text FROM v_web_mentions",
)
def src_reply_array(spark, sf):
    return L.parse_reply_array(V.landed_replies(spark, sf), "payload", keep=("monitor", "kw_rank")).drop("asked", "pos")


@query(
    "filt_recent",
    f"SELECT monitor, keyword, hit_rank, created_utc, title, selftext FROM v_posts WHERE created_utc >= {CUTOFF}",
)
def filt_recent(spark, sf):
    posts = V.post_hits(spark, sf).select("monitor", "keyword", "hit_rank", "created_utc", "title", "selftext")
    return M.recent(posts, V.EVENTS_AS_OF_SECONDS)


def _titled(spark, sf):
    d = V.table(spark, sf, "documents")
    return d.select("doc_id", F.concat(F.lit("Doc from "), "source").alias("title"), F.col("text").alias("summary"))


TITLED = "SELECT doc_id, 'Doc from ' || source AS title, text AS summary FROM documents"


@query("filt_exclude", f"SELECT * FROM ({TITLED}) WHERE {without('lower(title || chr(32) || summary)')}")
def filt_exclude(spark, sf):
    return M.exclude_phrases(_titled(spark, sf), V.EXCLUDED)


@query(
    "join_exclude_anti",
    f"""
SELECT * FROM ({TITLED}) d
WHERE NOT EXISTS (SELECT 1 FROM benchmark b, unnest(string_split(b.text, '.')) s(sentence)
                  WHERE trim(sentence, {WS}) <> ''
                    AND contains(lower(d.title || ' ' || d.summary), lower(trim(sentence, {WS}))))""",
)
def join_exclude_anti(spark, sf):
    """The phrase table are the sentences of the benchmark passages."""
    sentences = V.table(spark, sf, "benchmark").select(F.explode(F.split("text", r"\.")).alias("sentence"))
    phrases = sentences.select(X.ws_trim(F.col("sentence")).alias("phrase")).where("phrase <> ''")
    return M.exclude_phrases(_titled(spark, sf), phrases)


WINDOWS = """
SELECT DISTINCT array_to_string(w[i:i + n - 1], ' ') AS phrase
FROM (SELECT string_split(text, ' ') AS w FROM benchmark), unnest([4, 5, 6]) l(n), unnest(range(1, len(w) - n + 2)) r(i)"""


@query(
    "join_exclude_index",
    f"""
SELECT doc_id, title FROM ({TITLED}) d
WHERE NOT EXISTS (SELECT 1 FROM ({WINDOWS}) WHERE contains(lower(d.title || ' ' || d.summary), lower(phrase)))""",
)
def join_exclude_index(spark, sf):
    """The phrase table are all runs of four, five and six words of the benchmark passages, thousands of them."""
    words = V.table(spark, sf, "benchmark").select(F.split("text", " ").alias("w"))
    lengths = words.select("w", F.explode(F.array(F.lit(4), F.lit(5), F.lit(6))).alias("n")).where(F.size("w") >= F.col("n"))
    starts = lengths.select("w", "n", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("i"))
    phrases = starts.select(F.array_join(F.slice("w", F.col("i"), F.col("n")), " ").alias("phrase"))
    return M.exclude_phrases(_titled(spark, sf), phrases).select("doc_id", "title")


@query("filt_has_url", "SELECT * FROM v_mentions WHERE url <> ''")
def filt_has_url(spark, sf):
    return M.has_url(V.mentions(spark, sf))


def _queries(spark, sf):
    parts = V.table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("keyword"))
    return M.expand_queries(parts, V.TEMPLATES)


QUERIES = f"""
SELECT p_partkey, p_name AS keyword, pos AS template_pos, template, replace(template, '{{keyword}}', p_name) AS query
FROM part, {values(enumerate(V.TEMPLATES))} t(pos, template)"""


@query("join_expand_queries", f"SELECT * EXCLUDE (template) FROM ({QUERIES})")
def join_expand_queries(spark, sf):
    return _queries(spark, sf)


@query(
    "filt_template_prefix",
    f"SELECT * EXCLUDE (template) FROM ({QUERIES}) WHERE NOT starts_with(trim(query, {WS}), 'site:reddit.com')",
)
def filt_template_prefix(spark, sf):
    return M.keep_templates(_queries(spark, sf), column="query")


@query(
    "proj_defaults",
    """
SELECT * REPLACE (coalesce(keyword, 'unknown') AS keyword, coalesce(source, 'Other') AS source, coalesce(score, 0) AS score),
       coalesce(sentiment, 'neutral') AS icon_sentiment FROM v_mentions""",
)
def proj_defaults(spark, sf):
    return M.with_defaults(V.mentions(spark, sf))


ORDERED = ("tion", "the", "absentword")


@query(
    "join_keyword_order",
    f"SELECT m.*, list_rank FROM v_mentions m JOIN {values(enumerate(ORDERED, 1))} k(list_rank, keyword) USING (keyword)",
)
def join_keyword_order(spark, sf):
    return M.listed(V.mentions(spark, sf), ORDERED)


SENTIMENT_ICON = (
    "CASE coalesce(sentiment, 'neutral') WHEN 'positive' THEN ':large_green_circle:'"
    " WHEN 'negative' THEN ':red_circle:' ELSE ':white_circle:' END"
)
SOURCE_ICON = (
    "CASE lower(source) "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in M.SOURCE_ICONS.items())
    + " ELSE ':link:' END"
)


@query(
    "join_lookup_default",
    f"""
SELECT monitor, keyword, src_rank, hit_rank, source, sentiment, {SOURCE_ICON} AS source_icon,
       {SENTIMENT_ICON} AS sentiment_icon FROM v_mentions""",
)
def join_lookup_default(spark, sf):
    return V.mentions(spark, sf).select(
        "monitor", "keyword", "src_rank", "hit_rank", "source", "sentiment",
        M.source_icon(F.col("source")).alias("source_icon"),
        M.sentiment_icon(F.col("sentiment")).alias("sentiment_icon"),
    )


@query(
    "agg_sentiment",
    """
SELECT monitor, count(*) AS total, count(*) FILTER (WHERE sentiment = 'positive') AS positive,
       count(*) FILTER (WHERE sentiment = 'neutral') AS neutral,
       count(*) FILTER (WHERE sentiment = 'negative') AS negative FROM v_mentions GROUP BY ALL""",
)
def agg_sentiment(spark, sf):
    return M.sentiment_counts(V.mentions(spark, sf))


@query(
    "agg_keyword_source",
    """
SELECT monitor, keyword, coalesce(source, 'Other') AS source, count(*) AS mentions, 0 AS level FROM v_mentions GROUP BY ALL
UNION ALL SELECT monitor, keyword, NULL, count(*), 1 FROM v_mentions GROUP BY monitor, keyword""",
)
def agg_keyword_source(spark, sf):
    return M.keyword_source_counts(V.mentions(spark, sf))


@query("dedupe_by_url", "SELECT * FROM v_unique_mentions")
def dedupe_by_url(spark, sf):
    return M.first_per_url(V.mentions(spark, sf))


@query(
    "dedupe_keywords_ci",
    """
WITH base AS (SELECT p_brand AS list, p_partkey AS pos, p_type AS keyword FROM part),
extra AS (SELECT p_brand AS list, p_partkey AS pos,
                 CASE WHEN p_partkey % 2 = 0 THEN lower(p_type) ELSE upper(p_name) END AS keyword FROM part)
SELECT *, 0 AS origin FROM base UNION ALL
SELECT *, 1 FROM (SELECT * FROM extra QUALIFY row_number() OVER (PARTITION BY list, lower(keyword) ORDER BY pos) = 1) e
WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.list = e.list AND lower(b.keyword) = lower(e.keyword))""",
)
def dedupe_keywords_ci(spark, sf):
    part = V.table(spark, sf, "part")
    key = (F.col("p_brand").alias("list"), F.col("p_partkey").alias("pos"))
    added = F.when(F.col("p_partkey") % 2 == 0, F.lower("p_type")).otherwise(F.upper("p_name"))
    base = part.select(*key, F.col("p_type").alias("keyword"))
    return M.merge_keywords(base, part.select(*key, added.alias("keyword")), ["list"])


@query(
    "win_rank_in_source",
    """
SELECT *, row_number() OVER (
  PARTITION BY monitor, keyword, source
  ORDER BY CASE WHEN source = 'Reddit' THEN -coalesce(score, 0) ELSE 0 END, kw_rank, src_rank, hit_rank) AS place
FROM v_mentions""",
)
def win_rank_in_source(spark, sf):
    return M.rank_in_source(V.mentions(spark, sf), [F.col(c) for c in P.ARRIVAL])


@query(
    "sort_sources",
    f"""
SELECT monitor, list_rank, source, count(*) AS n FROM v_mentions
JOIN {values(enumerate(ORDERED, 1))} k(list_rank, keyword) USING (keyword)
GROUP BY ALL ORDER BY monitor, list_rank, source""",
)
def sort_sources(spark, sf):
    folded = V.mentions(spark, sf).groupBy("monitor", "keyword", "source").agg(F.count("*").alias("n"))
    return M.listed(folded, ORDERED).select("monitor", "list_rank", "source", "n").orderBy("monitor", "list_rank", "source")


BOTH = f"SELECT {MENTION} FROM v_post_mentions UNION ALL SELECT {MENTION} FROM v_comment_mentions"


@query("set_union_posts_comments", BOTH)
def set_union_posts_comments(spark, sf):
    posts = L.read_listing(V.landed_posts(spark, sf), "post", keep=KEEP)
    comments = L.read_listing(V.landed_comments(spark, sf), "comment", keep=KEEP)
    return posts.unionByName(comments).drop("pos", "created_utc")


@query("set_union_sources", f"{BOTH} UNION ALL SELECT {MENTION} FROM v_web_mentions")
def set_union_sources(spark, sf):
    reply = L.parse_reply_array(V.landed_replies(spark, sf), "payload", keep=("monitor", "kw_rank"))
    return M.union_sources(set_union_posts_comments(spark, sf), reply.drop("asked", "pos", "date_text"))


COLLECTED = f"""
SELECT * FROM (
  SELECT * FROM (SELECT * FROM v_post_mentions UNION ALL SELECT * FROM v_comment_mentions)
  WHERE created_utc >= {CUTOFF} AND {without("lower(title || ' ' || coalesce(summary, ''))")}
  UNION ALL SELECT * FROM v_web_mentions)
WHERE url <> '' QUALIFY row_number() OVER (PARTITION BY monitor, url ORDER BY kw_rank, src_rank, hit_rank) = 1"""


def collected(spark, sf):
    return P.collect_mentions(
        V.landed_posts(spark, sf),
        V.landed_comments(spark, sf),
        V.landed_replies(spark, sf),
        V.EXCLUDED,
        V.EVENTS_AS_OF_SECONDS,
    )


@query("collect_mentions", f"SELECT {MENTION}, src_rank FROM ({COLLECTED})")
def collect_mentions(spark, sf):
    return collected(spark, sf).drop("page", "pos", "date_text")


ITEM = f"""'  ' || {SENTIMENT_ICON} || ' <' || url || '|' || title || '>'
  || CASE WHEN coalesce(subreddit, '') <> '' THEN ' [' || subreddit || ']' ELSE '' END
  || CASE WHEN coalesce(score, 0) <> 0 THEN ' ↑' || score ELSE '' END
  || CASE WHEN date IS NOT NULL THEN '  _' || date || '_' ELSE '' END"""
SNIPPET = "CASE WHEN length(summary) > 140 THEN left(summary, 140) || '...' ELSE summary END"


@query(
    "fn_digest_line",
    f"SELECT monitor, keyword, src_rank, hit_rank, {ITEM} AS line FROM v_mentions WHERE url <> ''",
)
def fn_digest_line(spark, sf):
    rows = M.has_url(V.mentions(spark, sf))
    return rows.select("monitor", "keyword", "src_rank", "hit_rank", G.mention_line().alias("line"))


def _plural(n):
    return f"CASE WHEN {n} <> 1 THEN 's' ELSE '' END"


@query(
    "digest_mentions",
    f"""
WITH m AS (SELECT * REPLACE (coalesce(source, 'Other') AS source) FROM ({COLLECTED})),
ranks AS (SELECT * FROM {values(enumerate(ORDERED, 1))} k(list_rank, keyword)),
head AS (
  SELECT monitor, 0 AS section, 0 AS k0, '' AS k1, 0 AS k2, [
    '*Web Mentions — Jan 31, 2024*',
    '_keywords: {", ".join(ORDERED)} · ' || count(*) || ' mention' || {_plural("count(*)")} || ' · :large_green_circle: '
    || count(*) FILTER (WHERE sentiment = 'positive') || '  :white_circle: '
    || count(*) FILTER (WHERE sentiment = 'neutral') || '  :red_circle: '
    || count(*) FILTER (WHERE sentiment = 'negative') || '_'] AS lines
  FROM m GROUP BY monitor),
kw AS (
  SELECT monitor, 1 AS section, list_rank AS k0, '' AS k1, 0 AS k2,
         [chr(10) || '*' || keyword || '* — ' || count(*) || ' mention' || {_plural("count(*)")}] AS lines
  FROM m JOIN ranks USING (keyword) GROUP BY monitor, list_rank, keyword),
src AS (
  SELECT monitor, 1 AS section, list_rank AS k0, source AS k1, 0 AS k2,
         [{SOURCE_ICON} || ' *' || source || '* (' || count(*) || ')'] AS lines
  FROM m JOIN ranks USING (keyword) GROUP BY monitor, list_rank, source),
items AS (
  SELECT monitor, 1 AS section, list_rank AS k0, source AS k1, row_number() OVER (
           PARTITION BY monitor, keyword, source
           ORDER BY CASE WHEN source = 'Reddit' THEN -coalesce(score, 0) ELSE 0 END, kw_rank, src_rank, hit_rank) AS k2,
         [{ITEM}] || CASE WHEN coalesce(summary, '') <> '' THEN ['    _' || {SNIPPET} || '_']
                          ELSE CAST([] AS VARCHAR[]) END AS lines
  FROM m JOIN ranks USING (keyword)),
lined AS (
  SELECT monitor, section, k0, k1, k2, unnest(lines) AS line, generate_subscripts(lines, 1) AS part
  FROM (SELECT * FROM head UNION ALL SELECT * FROM kw UNION ALL SELECT * FROM src UNION ALL SELECT * FROM items))
SELECT monitor, row_number() OVER (PARTITION BY monitor ORDER BY section, k0, k1, k2, part) AS line_no, line FROM lined""",
)
def digest_mentions(spark, sf):
    arrival = ("kw_rank", "src_rank", "page", "pos")
    tenants = V.landed_replies(spark, sf)
    return G.mention_digest(collected(spark, sf), ORDERED, "Jan 31, 2024", arrival, tenants=tenants)
