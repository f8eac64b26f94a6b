"""Landed API replies (JSON text, one reply per row) to typed rows.

Every reader keeps the given columns of the reply's row next to the parsed
ones. A reply is bounded by its API (14 days, 10 entries, 25 hits), so the
arrays unpacked here are short; broken replies yield no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpulse import schemas as S
from outpulse.functions import dates as D
from outpulse.functions import text as X

# Address and source name of listing hits.
LISTING_SITE = "https://reddit.com"
LISTING_SOURCE = "Reddit"

TRAFFIC_NAMES = {"views": ("views", "unique_visitors"), "clones": ("clones", "unique_cloners")}
POPULAR_NAMES = {"referrers": "referrer", "paths": "path"}


def _kept(keep: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in keep]


def read_traffic(df: DataFrame, kind: str, json: str = "payload", keep: Sequence[str] = ("repo",)) -> DataFrame:
    """Daily series of a ``views`` or ``clones`` reply: one row per reported day."""
    count, uniques = TRAFFIC_NAMES[kind]
    points = F.from_json(json, S.TRAFFIC_JSON[kind])[kind]
    return df.select(*_kept(keep), F.posexplode(points).alias("pos", "p")).select(
        *keep,
        D.iso_date(F.col("p.timestamp")).alias("date"),
        F.col("p.count").alias(count),
        F.col("p.uniques").alias(uniques),
        "pos",
    )


def read_traffic_totals(
    df: DataFrame, kind: str, json: str = "payload", keep: Sequence[str] = ("repo",)
) -> DataFrame:
    """Totals the same reply carries for its whole look-back."""
    reply = F.from_json(json, S.TRAFFIC_JSON[kind])
    return df.select(*_kept(keep), reply.alias("r")).select(
        *keep, F.coalesce("r.count", F.lit(0)).alias("count"), F.coalesce("r.uniques", F.lit(0)).alias("uniques")
    )


def read_popular(
    df: DataFrame, kind: str, as_of: Column | date, json: str = "payload", keep: Sequence[str] = ("repo",)
) -> DataFrame:
    """Snapshot rows of a ``referrers`` or ``paths`` reply, stamped with the run date."""
    name = POPULAR_NAMES[kind]
    stamp = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")
    entries = F.from_json(json, S.POPULAR_JSON[kind])
    return df.select(*_kept(keep), stamp.alias("fetched_date"), F.posexplode(entries).alias("pos", "e")).select(
        *keep,
        "fetched_date",
        F.col(f"e.{name}").alias(name),
        F.col("e.count").alias("views"),
        F.col("e.uniques").alias("unique_visitors"),
        "pos",
    )


def read_repo_info(
    df: DataFrame, as_of: Column | date, json: str = "payload", keep: Sequence[str] = ("repo",)
) -> DataFrame:
    """Repository counters of one reply as a snapshot row."""
    stamp = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")
    info = F.from_json(json, S.REPO_INFO_JSON)
    return df.select(*_kept(keep), stamp.alias("date"), info.alias("i")).select(
        *keep,
        "date",
        F.col("i.stargazers_count").alias("stars"),
        F.col("i.forks_count").alias("forks"),
        F.col("i.subscribers_count").alias("watchers"),
        F.col("i.open_issues_count").alias("open_issues"),
    )


def read_listing(
    df: DataFrame, kind: str = "post", json: str = "payload", keep: Sequence[str] = ("keyword",)
) -> DataFrame:
    """Search listing to mention rows; ``kind`` is ``post`` or ``comment``.

    ``pos`` is the place in the reply, ``created_utc`` stays for the recency
    filter. Hits without a creation time are dropped.
    """
    children = F.from_json(json, S.LISTING_JSON)["data"]["children"]
    hits = df.select(*_kept(keep), F.posexplode(children).alias("pos", "child")).select(*keep, "pos", "child.data.*")
    empty = F.lit("")
    if kind == "post":
        title = F.coalesce("title", empty)
        text = X.summary(F.col("selftext"), F.col("url"))
        sub = F.coalesce("subreddit_name_prefixed", empty)
    else:
        sub = F.concat(F.lit("r/"), F.coalesce("subreddit", empty))
        title = F.concat(F.lit("Comment in "), sub)
        text = X.summary(F.col("body"))
    return hits.where(F.col("created_utc").isNotNull()).select(
        *keep,
        "pos",
        "created_utc",
        title.alias("title"),
        F.concat(F.lit(LISTING_SITE), F.coalesce("permalink", empty)).alias("url"),
        F.lit(LISTING_SOURCE).alias("source"),
        text.alias("summary"),
        F.lit("neutral").alias("sentiment"),
        D.epoch_date(F.col("created_utc")).alias("date"),
        sub.alias("subreddit"),
        F.coalesce("score", F.lit(0)).alias("score"),
    )


def read_search_items(df: DataFrame, json: str = "payload", keep: Sequence[str] = ("keyword",)) -> DataFrame:
    """Search result items with empty defaults; ``pos`` is the place in the reply."""
    items = F.from_json(json, S.SEARCH_JSON)["items"]
    hits = df.select(*_kept(keep), F.posexplode(items).alias("pos", "i"))
    return hits.select(
        *keep, "pos", *[F.coalesce(f"i.{c}", F.lit("")).alias(c) for c in ("link", "title", "snippet")]
    )


def read_threads(df: DataFrame, json: str = "payload", keep: Sequence[str] = ("url",)) -> DataFrame:
    """Discussion threads: post text and the first usable comments.

    The reply is a two-element array whose elements differ in shape. A reply
    without a post or without a comment list counts as not fetched and is
    dropped, so that the caller falls back to the search snippet.
    """
    parts = F.from_json(json, "array<string>")
    post = F.from_json(F.get(parts, F.lit(0)), S.THREAD_POST_JSON)["data"]["children"]
    comments = F.from_json(F.get(parts, F.lit(1)), S.THREAD_COMMENTS_JSON)["data"]["children"]
    flat = df.select(
        *_kept(keep),
        F.get(post, F.lit(0))["data"].alias("_post"),
        F.transform(comments, lambda c: F.struct(c["kind"].alias("kind"), c["data"]["body"].alias("body"))).alias(
            "_comments"
        ),
    )
    return flat.where(F.col("_post").isNotNull() & F.col("_comments").isNotNull()).select(
        *keep,
        X.ws_trim(F.coalesce("_post.selftext", F.lit(""))).alias("selftext"),
        X.clean_comments(F.col("_comments")).alias("comments"),
    )


def _one_value(text: Column) -> Column:
    """The text as a variant if all of it is one JSON value. The parser stops after a value, so the text is put in brackets."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(F.try_variant_get(listed, "$[1]", "variant").isNull(), F.try_variant_get(listed, "$[0]", "variant"))


def parse_reply_array(
    df: DataFrame, text: str = "reply", keyword: str = "keyword", keep: Sequence[str] = ()
) -> DataFrame:
    """Mention rows of a model reply; the asked keyword fills a missing one.

    The asked keyword stays as ``asked``: it decides the arrival order. The
    date is kept as it was written (``date_text``, which digests print) beside
    the day it names, if it names one.
    """
    bare = X.strip_fence(F.col(text))
    # The lenient reader takes a valid beginning; a reply counts only if all of it is one JSON value.
    found = F.when(_one_value(bare).isNotNull(), F.from_json(bare, S.REPLY_ARRAY_JSON))
    rows = df.select(*_kept(keep), F.col(keyword).alias("asked"), F.posexplode(found).alias("pos", "m"))
    return rows.where(F.col("m").isNotNull()).select(
        *keep,
        "asked",
        "pos",
        F.coalesce("m.keyword", "asked").alias("keyword"),
        *[F.col(f"m.{c}").alias(c) for c in ("title", "url", "source", "summary", "sentiment")],
        D.strict_date(F.col("m.date")).alias("date"),
        F.col("m.date").alias("date_text"),
    )


def parse_reply_score(df: DataFrame, text: str = "reply") -> DataFrame:
    """Adds ``relevance_score`` and ``suggested_comment``; rows with unusable replies are dropped."""
    bare = X.ws_trim(F.col(text))
    whole = _one_value(bare)
    comment = F.schema_of_variant(F.try_variant_get(whole, "$.suggested_comment", "variant"))
    usable = whole.isNotNull() & (comment.isNull() | (comment == "STRING"))
    parsed = F.when(usable, F.from_json(bare, S.REPLY_SCORE_JSON))
    kept = [c for c in df.columns if c != text]
    rows = df.select(*kept, parsed.alias("_score")).where(F.col("_score.relevance_score").isNotNull())
    return rows.select(
        *kept,
        F.col("_score.relevance_score").alias("relevance_score"),
        X.ws_trim(F.coalesce("_score.suggested_comment", F.lit(""))).alias("suggested_comment"),
    )
