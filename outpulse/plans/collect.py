"""Whole flows: collecting traffic, collecting mentions, finding opportunities."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpulse.operators import mentions as M
from outpulse.operators import outreach as O
from outpulse.operators.keyed import first_per_key, join_lookup, unseen
from outpulse.schemas import ARCHIVES, SEEN
from outpulse.sources import ledger
from outpulse.sources.archive import update_archive
from outpulse.sources.landing import (
    POPULAR_NAMES,
    TRAFFIC_NAMES,
    parse_reply_array,
    read_listing,
    read_popular,
    read_repo_info,
    read_search_items,
    read_threads,
    read_traffic,
)
from outpulse.sources.seen import seen_rows

ARRIVAL = ("kw_rank", "src_rank", "hit_rank")


def collect_traffic(
    spark: SparkSession,
    root: str,
    replies: Mapping[str, DataFrame],
    as_of: date,
    stamp: Column | None = None,
    scope: str = "all",
) -> dict[str, int]:
    """Archive one run's landed replies and return the rows added per dataset.

    ``replies`` maps datasets to ``(repo, payload)``; snapshots are stamped
    with ``as_of`` unless the replies carry their own ``stamp``. Repeating a
    run adds nothing.
    """
    day = F.lit(as_of) if stamp is None else stamp
    added = {}
    for kind, df in replies.items():
        if kind in TRAFFIC_NAMES:
            rows = read_traffic(df, kind).withColumnRenamed("pos", "_seq")
        elif kind in POPULAR_NAMES:
            rows = read_popular(df, kind, day).withColumnRenamed("pos", "_seq")
        else:
            rows = read_repo_info(df, day).withColumn("_seq", F.lit(0))
        # Rows that only differ in their counts are ordered by them, so that "first" is the same in every run.
        counts = [c for c in ARCHIVES[kind].fields if c not in ARCHIVES[kind].keys]
        added[kind] = update_archive(spark, root, kind, rows, as_of, ["_seq", *counts], scope)
    return added


def collect_mentions(
    posts: DataFrame,
    comments: DataFrame,
    replies: DataFrame,
    excluded: Sequence[str] | DataFrame,
    as_of: int,
    days: int = 1,
    by: Sequence[str] = ("monitor",),
) -> DataFrame:
    """Landed listings and model replies to one row per URL.

    Each input is ``(*by, kw_rank, keyword, page, payload)``; ``page`` orders
    the replies of a keyword. Age and exclusions apply to listing hits only:
    replies were asked for recent, relevant results.
    """
    keep = [*by, "kw_rank", "keyword", "page"]
    listings = []
    for rank, (df, kind) in enumerate(((posts, "post"), (comments, "comment")), 1):
        listings.append(M.recent(read_listing(df, kind, keep=keep), as_of, days).withColumn("src_rank", F.lit(rank)))
    reddit = M.exclude_phrases(listings[0].unionByName(listings[1]), excluded)
    web = parse_reply_array(replies, "payload", keep=[*by, "kw_rank", "page"]).drop("asked")
    merged = M.union_sources(reddit.drop("created_utc"), web.withColumn("src_rank", F.lit(3)))
    ranked = merged.withColumn("hit_rank", F.struct("page", "pos"))
    return M.first_per_url(ranked, by, ARRIVAL).drop("hit_rank")


def candidate_posts(
    hits: DataFrame,
    threads: DataFrame,
    seen: DataFrame,
    cursors: DataFrame,
    batches: Mapping[int, Sequence[str]],
    by: Sequence[str] = ("campaign",),
    per_run: int = O.BATCHES_PER_RUN,
    results: int = O.RESULTS_PER_KEYWORD,
) -> DataFrame:
    """Posts worth scoring: this run's keywords, first results, unseen, with their threads.

    Cheap filters come first: the seen store is consulted before threads are
    joined and long before the scorer runs.
    """
    searched = O.expand_batches(cursors, batches, per_run)
    searched = searched.select(*by, "keyword", "batch_pos", "batch_no", "kw_pos")
    found = join_lookup(hits, searched, [*by, "keyword"])
    order = ["batch_pos", "kw_pos", "hit_pos"]
    first = O.first_results(found, [*by, "batch_pos", "kw_pos"], ["hit_pos"], results)
    fresh = unseen(O.posts_from_hits(first), seen, order, by)
    fetched = first_per_key(threads, ["url"], ["page"]).drop("page")
    return O.attach_threads(fresh, fetched)


def find_opportunities(
    posts: DataFrame,
    scorer: Callable[[pd.Series], pd.Series],
    template: str,
    by: Sequence[str] = ("campaign",),
    n: int = O.MAX_RESULTS,
    min_score: float = O.MIN_SCORE,
    stages: Sequence[range] | None = None,
) -> DataFrame:
    """Score candidate posts and keep the first qualified ones of every run.

    With ``stages`` (ranges of batch positions, in order) scoring stops for a
    run as soon as it is full; without, all posts are scored in one job.
    """
    order = ["batch_pos", "kw_pos", "hit_pos"]
    prompted = posts.withColumn("prompt", O.post_prompt(template))
    if stages is not None:
        return O.score_until_full(prompted, scorer, by, "batch_pos", order, stages, n, min_score)
    return O.run_cap(O.qualify(O.score_posts(prompted, scorer), min_score), by, order, n)


_INT, _LONG, _TEXT = T.IntegerType(), T.LongType(), T.StringType()
OPPORTUNITY = T.StructType(
    [
        T.StructField("batch_pos", _INT),
        T.StructField("batch_no", _INT),
        T.StructField("kw_pos", _INT),
        T.StructField("keyword", _TEXT),
        T.StructField("page", _LONG),
        T.StructField("pos", _INT),
        T.StructField("url", _TEXT),
        T.StructField("subreddit", _TEXT),
        T.StructField("title", _TEXT),
        T.StructField("relevance_score", T.DoubleType()),
        T.StructField("suggested_comment", _TEXT),
    ]
)
CURSOR = T.StructType([T.StructField("next_batch", _INT)])


def _with(by: Sequence[str], schema: T.StructType) -> T.StructType:
    return T.StructType([*[T.StructField(c, T.StringType()) for c in by], *schema.fields])


def found_opportunities(spark: SparkSession, root: str, by: Sequence[str] = ("campaign",)) -> DataFrame:
    """What the finished runs of a ledger reported, with ``run_no``."""
    return ledger.finished(spark, root, "results", _with(by, OPPORTUNITY))


def seed_opportunities(
    spark: SparkSession, root: str, cursors: DataFrame, seen: DataFrame, as_of: date, by: Sequence[str] = ("campaign",)
) -> None:
    """Run 0 of a new ledger: first cursors (next_batch) and URLs that were reported before."""
    run = ledger.begin(spark, root)
    if run.run_no:
        raise ValueError(f"{root} has runs already")
    ledger.file_rows(run, "cursors", cursors.select(*by, F.col("next_batch").cast("int")))
    ledger.file_rows(run, "seen", seen.select(*by, *SEEN.names))
    ledger.finish(spark, run, as_of)


def run_opportunities(
    spark: SparkSession,
    root: str,
    searches: DataFrame,
    threads: DataFrame,
    batches: Mapping[int, Sequence[str]],
    scorer: Callable[[pd.Series], pd.Series],
    template: str,
    as_of: date,
    by: Sequence[str] = ("campaign",),
    per_run: int = O.BATCHES_PER_RUN,
    n: int = O.MAX_RESULTS,
    min_score: float = O.MIN_SCORE,
    before_finish: Callable[[ledger.Run], None] = lambda run: None,
) -> ledger.Run:
    """One whole run: landed search replies to reported posts, remembered URLs and the next cursors.

    ``searches`` is (*by, keyword, page, payload), ``threads`` (url, page,
    payload). Cursors and seen URLs are those of the finished runs of the
    ledger at ``root``. Results, seen URLs and cursors are written first and
    count only with the run's marker, the last thing written. A run that dies
    before it can be made again: it takes the same batches, and nothing is
    reported twice. Posts are scored once per attempt.
    """
    run = ledger.begin(spark, root)
    cursors = ledger.latest(spark, root, "cursors", _with(by, CURSOR))
    seen = ledger.finished(spark, root, "seen", _with(by, SEEN)).drop("run_no")
    hits = read_search_items(searches, keep=[*by, "keyword", "page"]).withColumn("hit_pos", F.struct("page", "pos"))
    posts = candidate_posts(hits, read_threads(threads, keep=("url", "page")), seen, cursors, batches, by, per_run)
    found = find_opportunities(posts, scorer, template, by, n, min_score)
    schema = _with(by, OPPORTUNITY)
    results = ledger.file_rows(run, "results", found.select(*[F.col(f.name).cast(f.dataType) for f in schema]))
    ledger.file_rows(run, "seen", seen_rows(results, as_of, by))
    _, following = O.rotate(F.col("next_batch"), len(batches), per_run)
    ledger.file_rows(run, "cursors", cursors.select(*by, following.alias("next_batch")))
    before_finish(run)
    ledger.finish(spark, run, as_of)
    return run
