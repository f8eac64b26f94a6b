"""Opportunities: keyword batches, search hits, threads, scoring, caps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpulse.functions import text as X
from outpulse.operators.keyed import join_lookup, top_n_per
from outpulse.session import store
from outpulse.sources.landing import parse_reply_score

# Limits of a run.
RESULTS_PER_KEYWORD = 3
SEARCH_MAXIMUM = 10
BATCHES_PER_RUN = 2
MAX_RESULTS = 10
MIN_SCORE = 6

#: Share of a job's rows that may fail before the scorer counts as down.
FAILED_SHARE = 0.5


def rotate(cursor: Column, total: int, per_run: int = BATCHES_PER_RUN) -> tuple[Column, Column]:
    """Batch numbers of a run in order, and the cursor of the next run."""
    picked = F.transform(
        F.sequence(F.lit(0), F.lit(per_run - 1)), lambda i: (F.pmod(cursor - 1 + i, F.lit(total)) + 1).cast("int")
    )
    return picked, (F.pmod(cursor - 1 + per_run, F.lit(total)) + 1).cast("int")


def expand_batches(
    cursors: DataFrame,
    batches: Mapping[int, Sequence[str]],
    per_run: int = BATCHES_PER_RUN,
    cursor: str = "next_batch",
) -> DataFrame:
    """Keywords of the batches each cursor selects, in run order.

    The batch table is a short literal, so any number of cursors expands
    without a join.
    """
    table = F.create_map(
        *[x for no, words in batches.items() for x in (F.lit(no), F.array(*[F.lit(w) for w in words]))]
    )
    picked, _ = rotate(F.col(cursor), len(batches), per_run)
    runs = cursors.select("*", F.posexplode(picked).alias("batch_pos", "batch_no"))
    return runs.select("*", F.posexplode(F.try_element_at(table, "batch_no")).alias("kw_pos", "keyword"))


def first_results(
    hits: DataFrame, by: Sequence[str], order_by: Sequence[str | Column], n: int = RESULTS_PER_KEYWORD
) -> DataFrame:
    """First search results per keyword, before any other filter; a search returns ten at most, so more is refused."""
    if n > SEARCH_MAXIMUM:
        raise ValueError(f"a search has at most {SEARCH_MAXIMUM} results, not {n}")
    return top_n_per(hits, by, order_by, n)


def posts_from_hits(hits: DataFrame) -> DataFrame:
    """Discussion links as posts: canonical URL, forum, clean title."""
    kept = hits.where(X.link_has(F.col("link")))
    return (
        kept.withColumn("url", X.url_base(F.col("link")))
        .withColumn("subreddit", X.url_segment(F.col("link")))
        .withColumn("title", X.title_clean(F.col("title")))
        .drop("link")
    )


def attach_threads(posts: DataFrame, threads: DataFrame, on: Sequence[str] = ("url",)) -> DataFrame:
    """Post text and comments from fetched threads; without one, the snippet stands in."""
    found = threads.withColumn("_found", F.lit(True))
    body = F.when(F.col("_found"), X.body_fallback(F.col("selftext"), F.col("snippet"))).otherwise(F.col("snippet"))
    none = F.array().cast("array<string>")
    return (
        posts.join(found, list(on), "left")
        .withColumn("body", body)
        .withColumn("comments", F.coalesce("comments", none))
        .drop("selftext", "_found")
    )


def post_prompt(template: str) -> Column:
    """Prompt column of a post; marks: ``{subreddit} {title} {body} {comments}``."""
    return X.fill_template(
        template,
        {
            "subreddit": F.col("subreddit"),
            "title": F.col("title"),
            "body": F.coalesce(F.nullif(F.col("body"), F.lit("")), F.lit("(no body text)")),
            "comments": X.bullets(F.col("comments")),
        },
    )


def keyword_prompt(
    template: str, keyword: Column, as_of: Column, templates: Sequence[str], excluded: Sequence[str],
    skip: Sequence[str] = ("site:reddit.com",),
) -> Column:
    """Prompt column of a keyword; marks: ``{today} {keyword} {queries} {excluded}``."""
    used = [t for t in templates if not any(t.strip().startswith(p) for p in skip)]
    queries = F.array_join(
        F.transform(
            F.array(*[F.lit(t) for t in used]),
            lambda t: F.concat(F.lit("- "), F.replace(t, F.lit("{keyword}"), keyword)),
        ),
        "\n",
    )
    return X.fill_template(
        template,
        {
            "today": F.date_format(as_of, "MMMM dd, yyyy"),
            "keyword": keyword,
            "queries": queries,
            "excluded": F.lit(", ".join(excluded[:8]) or "none"),
        },
    )


def score_attempts(
    df: DataFrame, scorer: Callable[[pd.Series], pd.Series], prompt: str = "prompt", most_failed: float = FAILED_SHARE
) -> DataFrame:
    """Every row with the ``_reply`` of a vectorised scorer and its ``status``, ``scored`` or ``failed``; stored.

    A batch that fails is sent again by halves, down to single rows, so what
    fails is a row and not its batch. Replies are written before anything is
    made of them, so no row is scored again by what follows. Failures are
    counted over the whole job: if more than the share ``most_failed`` of all
    rows failed, the scorer is taken to be down and the job fails, whatever
    the batches or partitions. Null replies are replies.
    """

    @F.pandas_udf("reply string, status string")
    def ask(texts: pd.Series) -> pd.DataFrame:
        def replies(some: pd.Series) -> list[tuple[str | None, str]]:
            try:
                answers = list(scorer(some))
                if len(answers) != len(some):
                    raise ValueError(f"{len(answers)} replies to {len(some)} posts")
                return [(None if pd.isna(a) else a, "scored") for a in answers]
            except Exception:
                if len(some) <= 1:
                    return [(None, "failed")] * len(some)
                middle = len(some) // 2
                return replies(some.iloc[:middle]) + replies(some.iloc[middle:])

        return pd.DataFrame(replies(texts), columns=["reply", "status"])

    # Non-deterministic, so that no filter is pushed below the scorer.
    asked = df.withColumn("_asked", ask.asNondeterministic()(F.col(prompt)))
    asked = store(asked.select(*df.columns, F.col("_asked.reply").alias("_reply"), F.col("_asked.status").alias("status")), "scored")
    rows, failed = asked.agg(F.count("*"), F.count_if(F.col("status") == "failed")).first()
    if failed > most_failed * rows:
        raise RuntimeError(f"the scorer failed for {failed} of {rows} posts")
    return asked


def score_posts(df: DataFrame, scorer: Callable[[pd.Series], pd.Series], prompt: str = "prompt") -> DataFrame:
    """Rows with the score and comment of the scorer's reply (prompt text to reply JSON).

    Rows that failed (see :func:`score_attempts`, which also fails the job if
    the scorer is down) and rows with an unusable reply are left out.
    """
    asked = score_attempts(df, scorer, prompt)
    return parse_reply_score(asked.where(F.col("status") == "scored").drop("status"), "_reply")


def qualify(df: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Rows with a sufficient score and a comment that carries text."""
    return df.where(
        (F.col("relevance_score") >= min_score) & X.has_text(X.ws_trim(F.col("suggested_comment")))
    )


def run_cap(
    df: DataFrame, by: Sequence[str], order_by: Sequence[str | Column], n: int = MAX_RESULTS
) -> DataFrame:
    """First ``n`` qualified rows of a run."""
    return top_n_per(df, by, order_by, n)


def score_until_full(
    df: DataFrame,
    scorer: Callable[[pd.Series], pd.Series],
    by: Sequence[str],
    stage: str,
    order_by: Sequence[str | Column],
    stages: Sequence[range],
    n: int = MAX_RESULTS,
    min_score: float = MIN_SCORE,
    prompt: str = "prompt",
) -> DataFrame:
    """Same rows as scoring everything and then applying :func:`run_cap`, with fewer scorer calls.

    Rows are scored stage by stage: ``stage`` is the leading order column,
    ``stages`` are ranges of its values, in order. A run that is full drops
    out of later stages. The rows to score and each stage's result (at most
    ``n`` rows per run) are stored, so nothing is searched or scored twice.
    """
    keys = list(by)
    df = store(df, "candidates")
    kept: DataFrame | None = None
    for values in stages:
        part = df.where(F.col(stage).between(values.start, values.stop - 1))
        if kept is not None:
            full = kept.groupBy(*keys).count().where(F.col("count") >= n).select(*keys)
            part = join_lookup(part, full, keys, "left_anti")
        found = run_cap(qualify(score_posts(part, scorer, prompt), min_score), keys, order_by, n)
        found = store(found, "stage")
        kept = found if kept is None else kept.unionByName(found)
    if kept is None:
        raise ValueError("no stages given")
    return run_cap(kept, keys, order_by, n)


def run_counts(
    qualified: DataFrame, searched: DataFrame, by: Sequence[str], n: int = MAX_RESULTS,
    place: Sequence[str] = ("batch_pos", "kw_pos"), within: Sequence[str] = ("hit_pos",),
) -> DataFrame:
    """What a run reports at its end: results kept, and keywords searched until it was full.

    ``qualified`` are the posts with a sufficient score, ``searched`` all
    keywords of the run, both with the keyword's ``place``. A run stops before
    the keyword that follows its ``n``-th result.
    """
    kept = run_cap(qualified, by, [*place, *within], n)
    ends = kept.groupBy(*by).agg(F.count("*").alias("results"), F.max(F.struct(*place)).alias("_last"))
    needed = F.col("results").isNull() | (F.col("results") < n) | (F.struct(*place) <= F.col("_last"))
    return searched.join(ends, list(by), "left").groupBy(*by).agg(
        F.coalesce(F.max("results"), F.lit(0)).cast("long").alias("results"), F.count_if(needed).alias("searches")
    )
