"""Inputs of the registered queries, derived by Spark from the given tables.

Each view stands for one input of the library: archives from orders and
events, hits from events, mentions from documents, conversations and pages,
search hits from pages, threads from conversations. ``landed_*`` views are the
same data as JSON replies; a reply holds as many entries as its API returns.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outpulse.functions import dates as D
from outpulse.functions import text as X
from outpulse.operators.keyed import join_lookup
from outpulse.operators.traffic import daily_traffic

# Clocks of the queries.
ORDERS_AS_OF = date(2001, 8, 15)
ALL_MONTHS = 84
CUT = date(1998, 3, 1)
EVENTS_AS_OF = date(2024, 1, 31)
EVENTS_AS_OF_SECONDS = 1_706_659_200
EVENTS_RANGE = (date(2024, 1, 1), date(2024, 1, 30))

# Invented parameters, as a user's configuration would give them.
KEYWORDS = ("the", "license", "tion", "absentword")
EXCLUDED = ("license", "ouen")
TEMPLATES = (
    '"{keyword}" tools',
    "site:reddit.com {keyword}",
    '"{keyword}" open source',
    " site:reddit.com/r/x {keyword}",
    'site:example.org "{keyword}"',
)
BATCHES = {b: [f"topic {b}-{p}" for p in range(5)] for b in range(1, 16)}
POST_TEMPLATE = "{subreddit}\n{title}\n{body}\n{comments}"
KEYWORD_TEMPLATE = "{today}: {keyword}\n{queries}\nnot: {excluded}"
SCORED_PHRASES = ("the", "en", "tion", "license", "que", "der", "ing", "page", "thread", "ou", "ch", "con")


# Declared, so that no job has to look into a file before a query starts.
TABLES = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# Traffic


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the repository they count for."""
    return table(spark, sf, "events").withColumn("repo", _text("org/r", F.col("user_id") % 3))


def views(spark: SparkSession, sf: str) -> DataFrame:
    daily = daily_traffic(events(spark, sf).where("event_type = 'view'"), ["repo"])
    return daily.select(
        "repo", "date", F.col("count").alias("views"), F.col("uniques").alias("unique_visitors"),
        D.archive_month(F.col("date")).alias("archive_month"),
    )


def clones(spark: SparkSession, sf: str) -> DataFrame:
    daily = daily_traffic(events(spark, sf).where("event_type = 'click'"), ["repo"])
    return daily.select(
        "repo", "date", F.col("count").alias("clones"), F.col("uniques").alias("unique_cloners"),
        D.archive_month(F.col("date")).alias("archive_month"),
    )


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "*", _text("org/r", F.col("o_orderkey") % 5).alias("repo"), F.col("o_orderdate").cast("date").alias("day")
    )


def _popular(spark: SparkSession, sf: str, name: str, value: Column) -> DataFrame:
    rows = _orders(spark, sf).groupBy("repo", F.col("day").alias("fetched_date"), value.alias(name))
    per_user = rows.agg(F.count("*").alias("views"), F.count_distinct("o_custkey").alias("unique_visitors"))
    return per_user.withColumn("archive_month", D.archive_month(F.col("fetched_date")))


def referrers(spark: SparkSession, sf: str) -> DataFrame:
    return _popular(spark, sf, "referrer", _text("ref", F.col("o_custkey") % 40))


def paths(spark: SparkSession, sf: str) -> DataFrame:
    path = _text("/docs/", F.col("o_orderpriority"), "/a-rather-long-section-name/", F.col("o_custkey") % 60)
    return _popular(spark, sf, "path", path)


def repo_stats(spark: SparkSession, sf: str) -> DataFrame:
    daily = _orders(spark, sf).groupBy("repo", F.col("day").alias("date")).agg(
        F.count("*").alias("watchers"), F.count_if(F.col("o_orderstatus") == "F").alias("open_issues")
    )
    running = Window.partitionBy("repo").orderBy("date")
    return daily.select(
        "repo",
        "date",
        F.sum("watchers").over(running).alias("stars"),
        F.sum("open_issues").over(running).alias("forks"),
        "watchers",
        "open_issues",
        D.archive_month(F.col("date")).alias("archive_month"),
    )


def refiled_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Repository snapshots, and every one again a month later with another star count."""
    once = repo_stats(spark, sf)
    again = once.withColumn("stars", F.col("stars") + 1).withColumn(
        "archive_month", D.archive_month(F.add_months("date", 1))
    )
    return once.unionByName(again)


def existing(spark: SparkSession, sf: str) -> DataFrame:
    """The archive as it stood on the cut day."""
    return referrers(spark, sf).where(F.col("fetched_date") < F.lit(CUT))


def incoming(spark: SparkSession, sf: str) -> DataFrame:
    """The whole history again, delivered twice with other counts."""
    base = referrers(spark, sf).drop("archive_month")
    first, second = (
        base.withColumn("views", F.col("views") + 100 * n).withColumn("_seq", F.lit(n)) for n in (1, 2)
    )
    return first.unionByName(second)


# Landed traffic replies


def _entries(fields: dict[str, Column], order: Column) -> Column:
    """Group's rows as an array of structs in the given order."""
    rows = F.array_sort(F.collect_list(F.struct(order.alias("_o"), F.struct(*[c.alias(n) for n, c in fields.items()]).alias("e"))))
    return F.transform(rows, lambda r: r["e"])


def landed_traffic(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Replies of 14 days each: ``repo, block, payload``."""
    n, u = ("views", "unique_visitors") if kind == "views" else ("clones", "unique_cloners")
    daily = views(spark, sf) if kind == "views" else clones(spark, sf)
    block = F.floor(F.datediff("date", F.lit(date(2024, 1, 1))) / 14)
    stamp = _text(F.col("date"), "T00:00:00Z")
    points = _entries({"timestamp": stamp, "count": F.col(n), "uniques": F.col(u)}, F.col("date"))
    grouped = daily.groupBy("repo", block.alias("block")).agg(
        F.sum(n).alias("count"), F.sum(u).alias("uniques"), points.alias(kind)
    )
    return grouped.select("repo", "block", F.to_json(F.struct("count", "uniques", kind)).alias("payload"))


def landed_popular(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """One reply per repository and day: ``repo, run_date, payload``."""
    name = {"referrers": "referrer", "paths": "path"}[kind]
    daily = referrers(spark, sf) if kind == "referrers" else paths(spark, sf)
    fields = {name: F.col(name), "count": F.col("views"), "uniques": F.col("unique_visitors")}
    grouped = daily.groupBy("repo", F.col("fetched_date").alias("run_date")).agg(
        _entries(fields, F.struct(-F.col("views"), F.col(name))).alias("e")
    )
    return grouped.select("repo", "run_date", F.to_json("e").alias("payload"))


def landed_info(spark: SparkSession, sf: str) -> DataFrame:
    """One reply per repository and day: ``repo, run_date, payload``."""
    reply = F.struct(
        F.lit("main").alias("default_branch"),
        F.col("stars").alias("stargazers_count"),
        F.col("forks").alias("forks_count"),
        F.col("watchers").alias("subscribers_count"),
        F.col("open_issues").alias("open_issues_count"),
    )
    return repo_stats(spark, sf).select("repo", F.col("date").alias("run_date"), F.to_json(reply).alias("payload"))


# Web analytics


def hits(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    # Not partitioned by user afterwards: later folds per user and slot would
    # reuse that partitioning and meet a busy user in one task.
    countries = c.join(n, "n_nationkey").select("user_id", "country")
    page = F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 20
    medium, device = F.col("event_id") % 3, F.col("event_id") % 4
    return (
        join_lookup(e, countries, ["user_id"], "left").select(
            _text("p", F.col("user_id") % 3).alias("property_id"),
            "event_id",
            "user_id",
            "ts",
            "event_type",
            _text("/p/", page).alias("page_path"),
            F.when(page % 7 == 0, F.lit("(not set)")).otherwise(_text("Page ", page)).alias("page_title"),
            _text("src", F.col("event_id") % 6).alias("source"),
            F.when(medium == 0, "organic").when(medium == 1, "referral").otherwise("(none)").alias("medium"),
            F.coalesce("country", F.lit("(not set)")).alias("country"),
            F.when(device == 0, "mobile").when(device == 1, "tablet").otherwise("desktop").alias("device_category"),
        )
    )


# Mentions


def _per_keyword(df: DataFrame, text: str) -> DataFrame:
    """Each row once per keyword its whole text contains."""
    low = F.lower(F.col(text))
    found = [
        F.when(F.contains(low, F.lit(k)), F.struct(F.lit(r).alias("kw_rank"), F.lit(k).alias("keyword")))
        for r, k in enumerate(KEYWORDS, 1)
    ]
    return df.select("*", F.explode(F.array_compact(F.array(*found))).alias("k")).select("*", "k.*").drop("k")


def post_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as listing posts."""
    d, source = F.col("doc_id"), F.col("source")
    return _per_keyword(table(spark, sf, "documents"), "text").select(
        _text("m", d % 3).alias("monitor"),
        "kw_rank",
        "keyword",
        d.alias("hit_rank"),
        (F.lit(EVENTS_AS_OF_SECONDS) - (d * 3571) % 259_200).alias("created_utc"),
        _text("Post ", d, " in ", source).alias("title"),
        _text("/r/", source, "/comments/", F.md5("text")).alias("permalink"),
        F.col("text").alias("selftext"),
        _text("https://ex.org/d/", d).alias("url"),
        _text("r/", source).alias("subreddit_name_prefixed"),
        (F.col("n_chars") % 100).alias("score"),
    )


def comment_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as listing comments."""
    c, t, role = F.col("conv_id"), F.col("turn"), F.col("role")
    return _per_keyword(table(spark, sf, "conversations"), "text").select(
        _text("m", c % 3).alias("monitor"),
        "kw_rank",
        "keyword",
        (c * 1000 + t).alias("hit_rank"),
        (F.lit(EVENTS_AS_OF_SECONDS) - (c * 7919 + t * 613) % 259_200).alias("created_utc"),
        _text("/r/", role, "/comments/", c, "/", t).alias("permalink"),
        F.col("text").alias("body"),
        role.alias("subreddit"),
        (F.length("text") % 50).cast("bigint").alias("score"),
    )


def web_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as web mentions; some have no URL."""
    p, url = F.col("page_id"), F.col("url")
    found = _per_keyword(table(spark, sf, "pages"), "html")
    sentiment = (
        F.when(F.contains(url, F.lit("/en/")), "positive")
        .when(F.contains(url, F.lit("/de/")), "negative")
        .when(F.contains(url, F.lit("/fr/")), "neutral")
    )
    source = (
        F.when(F.contains(url, F.lit("example.com")), "GitHub")
        .when(F.contains(url, F.lit("example.net")), "Blog")
        .when(F.contains(url, F.lit("example.org")), "Forum")
    )
    shown = F.when(F.endswith(url, F.lit("#top")), F.lit(None)).when(F.endswith(url, F.lit(".html")), "").otherwise(url)
    return found.select(
        _text("m", p % 3).alias("monitor"),
        "kw_rank",
        "keyword",
        p.alias("hit_rank"),
        _text("Page ", p).alias("title"),
        shown.alias("url"),
        source.alias("source"),
        F.col("html").alias("summary"),
        sentiment.alias("sentiment"),
        F.lit("2024-01-30").alias("date"),
    )


def mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Posts, comments and web mentions of all ages as one mention table, in no order and with repeats."""
    posts = post_hits(spark, sf).select(
        "monitor", "kw_rank", "keyword", F.lit(1).alias("src_rank"), "hit_rank", "title",
        _text("https://reddit.com", F.col("permalink")).alias("url"), F.lit("Reddit").alias("source"),
        X.summary(F.col("selftext"), F.col("url")).alias("summary"), F.lit("neutral").alias("sentiment"),
        D.epoch_date(F.col("created_utc")).alias("date"), F.col("subreddit_name_prefixed").alias("subreddit"), "score",
    )
    comments = comment_hits(spark, sf).select(
        "monitor", "kw_rank", "keyword", F.lit(2).alias("src_rank"), "hit_rank",
        _text("Comment in r/", F.col("subreddit")).alias("title"),
        _text("https://reddit.com", F.col("permalink")).alias("url"), F.lit("Reddit").alias("source"),
        X.summary(F.col("body")).alias("summary"), F.lit("neutral").alias("sentiment"),
        D.epoch_date(F.col("created_utc")).alias("date"), _text("r/", F.col("subreddit")).alias("subreddit"), "score",
    )
    web = web_hits(spark, sf).withColumn("src_rank", F.lit(3)).withColumn("date", F.col("date").cast("date"))
    return posts.unionByName(comments).unionByName(web, allowMissingColumns=True)


def landed_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Listing replies of up to 25 posts: ``monitor, kw_rank, keyword, page, payload``."""
    names = ("created_utc", "title", "permalink", "selftext", "url", "subreddit_name_prefixed", "score")
    return _listing(post_hits(spark, sf), names, 25)


def landed_comments(spark: SparkSession, sf: str) -> DataFrame:
    """Listing replies of the comments of up to 25 conversations."""
    names = ("created_utc", "permalink", "body", "subreddit", "score")
    return _listing(comment_hits(spark, sf), names, 1000)


def _listing(rows: DataFrame, names: tuple[str, ...], size: int) -> DataFrame:
    data = F.struct(*names)
    children = _entries({"data": data}, F.col("hit_rank"))
    page = F.floor(F.col("hit_rank") / size).alias("page")
    grouped = rows.groupBy("monitor", "kw_rank", "keyword", page).agg(children.alias("children"))
    return grouped.select(
        "monitor", "kw_rank", "keyword", "page", F.to_json(F.struct(F.struct("children").alias("data"))).alias("payload")
    )


def landed_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Model replies of up to 25 mentions; every other one is fenced, most leave the keyword out."""
    asked = F.when(F.col("sentiment") == "positive", F.col("keyword"))
    fields = {"keyword": asked, **{n: F.col(n) for n in ("title", "url", "source", "summary", "sentiment", "date")}}
    page = F.floor(F.col("hit_rank") / 25)
    grouped = web_hits(spark, sf).groupBy("monitor", "kw_rank", "keyword", page.alias("page")).agg(
        _entries(fields, F.col("hit_rank")).alias("e")
    )
    body = F.to_json("e")
    fenced = F.when(F.col("page") % 2 == 0, _text("```json\n", body, "\n```\n")).otherwise(_text(" ", body, "\n"))
    return grouped.select("monitor", "kw_rank", "keyword", "page", fenced.alias("payload"))


# Outreach


def search_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as search results: ``campaign, keyword, hit_pos, link, title, snippet``."""
    p, url = F.col("page_id"), F.col("url")
    number = p % 75
    link = F.replace(F.replace(url, F.lit(".example."), F.lit(".reddit.com/r/")), F.lit("/en/"), F.lit("/comments/"))
    tail = F.when(F.contains(url, F.lit("/en/")), F.lit(" - Reddit ")).otherwise(F.lit(" "))
    return table(spark, sf, "pages").select(
        F.regexp_extract("url", r"example\.([a-z]+)", 1).alias("campaign"),
        _text("topic ", F.floor(number / 5) + 1, "-", number % 5).alias("keyword"),
        p.alias("hit_pos"),
        link.alias("link"),
        _text(" Page ", p, tail).alias("title"),
        F.col("html").alias("snippet"),
    )


def cursors(spark: SparkSession, sf: str) -> DataFrame:
    """One cursor per campaign, somewhere in the rotation."""
    return search_hits(spark, sf).groupBy("campaign").agg((F.count("*") % 15 + 1).cast("int").alias("next_batch"))


def seen(spark: SparkSession, sf: str) -> DataFrame:
    """Links with a query part were reported before."""
    rows = search_hits(spark, sf).where(F.contains("link", F.lit("?")))
    return rows.select(
        "campaign", X.url_base(F.col("link")).alias("url"), "title", F.lit(EVENTS_AS_OF).alias("date_seen")
    )


def landed_search(spark: SparkSession, sf: str) -> DataFrame:
    """Search replies of up to ten items: ``campaign, keyword, page, payload``."""
    page = F.floor(F.col("hit_pos") / 750).alias("page")
    items = _entries({n: F.col(n) for n in ("link", "title", "snippet")}, F.col("hit_pos"))
    grouped = search_hits(spark, sf).groupBy("campaign", "keyword", page).agg(items.alias("items"))
    return grouped.select("campaign", "keyword", "page", F.to_json(F.struct("items")).alias("payload"))


def comments(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as thread comments."""
    c, t = F.col("conv_id"), F.col("turn")
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "assistant", F.lit("t1")).otherwise(F.lit("more")).alias("kind"),
        F.when((c + t) % 10 == 0, F.lit("[deleted]")).otherwise(F.col("text")).alias("body"),
    )


def landed_threads(spark: SparkSession, sf: str) -> DataFrame:
    """Thread replies of up to ten comments: ``conv_id, page, payload``."""
    c = F.col("conv_id")
    listed = _entries({"kind": F.col("kind"), "data": F.struct("body")}, F.col("turn"))
    grouped = comments(spark, sf).groupBy("conv_id", F.floor(F.col("turn") / 10).alias("page")).agg(listed.alias("children"))
    own = F.when(c % 7 == 0, F.lit("[removed]")).otherwise(_text("  Thread ", c, " on things\n"))
    post = F.struct(F.struct(F.array(F.struct(F.struct(own.alias("selftext")).alias("data"))).alias("children")).alias("data"))
    rest = F.struct(F.struct("children").alias("data"))
    return grouped.select("conv_id", "page", _text("[", F.to_json(post), ",", F.to_json(rest), "]").alias("payload"))


def landed_thread_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Thread replies with the URL of the post they belong to: ``url, page, payload``."""
    links = search_hits(spark, sf).select(F.col("hit_pos").alias("conv_id"), X.url_base(F.col("link")).alias("url"))
    return landed_threads(spark, sf).join(links, "conv_id").select("url", "page", "payload")


def phrase_scorer(phrases: tuple[str, ...] = SCORED_PHRASES):
    """Deterministic stand-in for a model: score by phrases found, some replies unusable.

    The scorer is a closure, so it travels to the workers by value.
    """

    def reply(n: int) -> str:
        if n <= 2:
            return "no JSON here"
        comment = " " if n == 7 else f"found {n}"
        return f'{{"relevance_score": {n}, "suggested_comment": "{comment}"}}'

    def score(texts):
        low = texts.str.lower()
        found = sum(low.str.contains(p, regex=False).astype(int) for p in phrases)
        return found.clip(upper=10).map(reply)

    return score
