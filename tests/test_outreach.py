import json
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from outpulse.catalog import outreach_queries as Q
from outpulse.catalog import views as V
from outpulse.operators import outreach as O
from outpulse.plans import collect as C
from outpulse.schemas import SEEN
from outpulse.sources import ledger

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("cursor, want, following", [(9, [9, 10], 11), (15, [15, 1], 2), (1, [1, 2], 3)])
def test_rotation(one, cursor, want, following):
    picked, nxt = O.rotate(F.lit(cursor), 15)
    assert one(picked) == want
    assert one(nxt) == following


def test_rotation_visits_every_batch(one):
    cursor, visited = 4, set()
    for _ in range(8):
        picked, nxt = O.rotate(F.lit(cursor), 15)
        visited |= set(one(picked))
        cursor = one(nxt)
    assert visited == set(range(1, 16))


def test_batches_expand_in_order(spark):
    runs = spark.createDataFrame([("a", 15)], "campaign STRING, next_batch INT")
    rows = O.expand_batches(runs, {n: [f"{n}x", f"{n}y"] for n in range(1, 16)}).orderBy("batch_pos", "kw_pos").collect()
    assert [r.keyword for r in rows] == ["15x", "15y", "1x", "1y"]


def posts(spark, n=40):
    return spark.range(n).select(
        F.lit("c").alias("campaign"), F.floor(F.col("id") / 10).alias("batch_pos"), (F.col("id") % 10).alias("kw_pos"),
        F.lit(0).alias("hit_pos"), F.col("id").cast("string").alias("prompt"),
    )


def make_scorer():
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: f'{{"relevance_score": {5 + int(t) % 3}, "suggested_comment": "c{t}"}}')

    return score


scorer = make_scorer()


ORDER = ["batch_pos", "kw_pos", "hit_pos"]


def test_run_cap_takes_the_first_ten(spark):
    scored = O.qualify(O.score_posts(posts(spark), scorer))
    got = O.run_cap(scored, ["campaign"], ORDER).orderBy(*ORDER).collect()
    want = [n for n in range(40) if 5 + n % 3 >= 6][:10]
    assert [int(r.suggested_comment[1:]) for r in got] == want


def test_staged_scoring_equals_scoring_everything_and_calls_less(spark):
    calls = spark.sparkContext.accumulator(0)

    inner = make_scorer()

    def counting(texts):
        calls.add(len(texts))
        return inner(texts)

    two = posts(spark).unionByName(posts(spark, 13).withColumn("campaign", F.lit("d")))
    whole = O.run_cap(O.qualify(O.score_posts(two, scorer)), ["campaign"], ORDER)
    staged = O.score_until_full(two, counting, ["campaign"], "batch_pos", ORDER, [range(0, 1), range(1, 2), range(2, 4)])
    cols = ["campaign", *ORDER, "relevance_score", "suggested_comment"]
    assert sorted(staged.select(cols).collect()) == sorted(whole.select(cols).collect())
    assert calls.value == 20 + 13  # campaign c is full after two of four batches


def test_a_failing_reply_drops_its_row_only(spark):
    inner = make_scorer()

    def picky(texts):
        if (texts == "3").any():
            raise RuntimeError("refused")
        return inner(texts)

    got = O.score_posts(posts(spark, 6), picky).collect()
    assert sorted(r.prompt for r in got) == ["0", "1", "2", "4", "5"]


def test_filters_stay_above_the_scorer(spark):
    """Replies are written before they are read, so nothing that follows asks the scorer again."""
    calls = spark.sparkContext.accumulator(0)
    inner = make_scorer()

    def counting(texts):
        calls.add(len(texts))
        return inner(texts)

    df = O.qualify(O.score_posts(posts(spark, 24), counting))
    assert df.count() == df.where("relevance_score > 5").count() == 16
    assert calls.value == 24


def test_whole_and_staged_opportunities_agree(spark):
    one = Q.opportunities(spark, SF).collect()
    assert sorted(one) == sorted(Q.opportunities_staged(spark, SF).collect())
    assert 0 < len(one) <= 30


def test_first_results_come_before_the_link_filter(spark):
    hits = V.search_hits(spark, SF)
    first = O.first_results(hits, ["campaign", "keyword"], ["hit_pos"], 1)
    assert O.posts_from_hits(first).count() < first.count() < hits.count()


def test_thread_fallbacks(spark):
    rows = [("u1", "s" * 3000), ("u2", "s2"), ("u3", "s3")]
    df = spark.createDataFrame(rows, "url STRING, snippet STRING")
    threads = spark.createDataFrame([("u2", "body", ["c"]), ("u3", "[deleted]", None)], "url STRING, selftext STRING, comments ARRAY<STRING>")
    got = {r.url: (r.body, r.comments) for r in O.attach_threads(df, threads).collect()}
    assert got == {"u1": ("s" * 3000, []), "u2": ("body", ["c"]), "u3": ("s3", [])}


def test_keyword_prompt(one):
    got = one(O.keyword_prompt("{today}|{keyword}|{queries}|{excluded}", F.lit("kw"), F.lit(date(2026, 4, 5)),
                               ['"{keyword}" x', " site:reddit.com {keyword}", "{keyword} y"], [f"e{n}" for n in range(9)]))
    assert got == 'April 05, 2026|kw|- "kw" x\n- kw y|' + ", ".join(f"e{n}" for n in range(8))


def test_candidates_are_unseen_and_unique(spark):
    posts_ = Q._candidates(spark, SF)
    assert posts_.count() == posts_.select("campaign", "url").distinct().count()
    assert posts_.join(V.seen(spark, SF), ["campaign", "url"], "left_semi").count() == 0


def test_counts_stop_with_the_tenth_result(spark):
    """Against the loop that searches keyword by keyword until it has ten results."""
    searched = spark.createDataFrame([("c", b, k) for b in range(4) for k in range(3)] + [("none", 0, 0)],
                                     "campaign STRING, batch_pos INT, kw_pos INT")
    for per_keyword in (1, 2, 5):
        found = [("c", b, k, h) for b in range(4) for k in range(3) for h in range(per_keyword) if (b + k) % 2 == 0]
        results = searches = 0
        for b in range(4):
            for k in range(3):
                if results < 10:
                    searches += 1
                    results = min(10, results + sum(x[1:3] == (b, k) for x in found))
        df = spark.createDataFrame(found, "campaign STRING, batch_pos INT, kw_pos INT, hit_pos INT")
        got = {r.campaign: (r.results, r.searches) for r in O.run_counts(df, searched, ["campaign"]).collect()}
        assert got == {"c": (results, searches), "none": (0, 1)}


@pytest.mark.parametrize(("rows", "partitions"), [(1, 1), (2, 2), (3, 1), (3, 3), (12, 6), (12, 1), (40, 1)])
def test_an_outage_fails_the_job(spark, rows, partitions):
    """Whatever the batches: no rows and no error would look like a quiet day."""

    def down(texts):
        raise RuntimeError("unavailable")

    with pytest.raises(RuntimeError, match=f"failed for {rows} of {rows}"):
        O.score_posts(posts(spark, rows).repartition(partitions), down)


def test_failures_are_counted_over_the_job(spark):
    """Some batches of failures only are no outage; a share above the limit is one."""
    inner = make_scorer()

    def picky(texts):
        if (texts.astype(int) < 4).any():
            raise RuntimeError("refused")
        return inner(texts)

    some = posts(spark, 12).repartition(6, "prompt")
    asked = O.score_attempts(some, picky).collect()
    assert {r.prompt: r.status for r in asked} == {str(i): "failed" if i < 4 else "scored" for i in range(12)}
    assert O.score_posts(some, picky).count() == 8
    with pytest.raises(RuntimeError, match="failed for 4 of 12"):
        O.score_attempts(some, picky, most_failed=0.25)
    assert O.score_posts(some.limit(0), picky).count() == 0

    def short(texts):
        return inner(texts).iloc[:-1] if len(texts) > 1 else inner(texts)

    assert {r.status for r in O.score_attempts(some.coalesce(1), short).collect()} == {"scored"}


def _searches(spark, items):
    """Replies of one keyword each: (keyword, links) for campaign c."""
    reply = lambda links: json.dumps({"items": [{"link": f"https://reddit.com/r/x/comments/{n}/?a", "title": f"t{n}", "snippet": n} for n in links]})
    return spark.createDataFrame([("c", k, 0, reply(links)) for k, links in items.items()], "campaign STRING, keyword STRING, page LONG, payload STRING")


def test_a_run_counts_only_with_its_marker(spark, tmp_path):
    """Runs take batch after batch; one that dies is made again; no post is reported twice."""
    root = str(tmp_path / "runs")
    batches = {1: ["a"], 2: ["b"], 3: ["c"]}
    searches = _searches(spark, {"a": ["1", "2", "3", "9"], "b": ["2", "4"], "c": ["5", "1", "77"]})
    threads = spark.createDataFrame([], "url STRING, page LONG, payload STRING")
    day = date(2026, 1, 5)
    seen = spark.createDataFrame([("c", "https://reddit.com/r/x/comments/77", "old", day)], "campaign STRING, url STRING, title STRING, date_seen DATE")
    C.seed_opportunities(spark, root, spark.createDataFrame([("c", 3)], "campaign STRING, next_batch INT"), seen, day)
    with pytest.raises(ValueError):
        C.seed_opportunities(spark, root, seen, seen, day)

    def run(**more):
        def reply(texts):
            return texts.map(lambda t: f'{{"relevance_score": 7, "suggested_comment": "{t}"}}')

        return C.run_opportunities(spark, root, searches, threads, batches, reply, "{title}", day, per_run=1, **more)

    def dies(_):
        raise InterruptedError

    def reported():
        return {(r.run_no, r.title) for r in C.found_opportunities(spark, root).collect()}

    with pytest.raises(InterruptedError):
        run(before_finish=dies)
    assert reported() == set()
    assert [run().run_no, run().run_no] == [1, 2]
    assert reported() == {(1, "t5"), (1, "t1"), (2, "t2"), (2, "t3")}
    with pytest.raises(InterruptedError):
        run(before_finish=dies)
    run()
    want = {(1, "t5"), (1, "t1"), (2, "t2"), (2, "t3"), (3, "t4")}
    assert reported() == want
    run()
    assert reported() == want  # batch 3 again: all seen
    assert ledger.latest(spark, root, "cursors", C._with(["campaign"], C.CURSOR)).collect() == [("c", 1)]
    urls = [r.url for r in ledger.finished(spark, root, "seen", C._with(["campaign"], SEEN)).collect()]
    assert len(urls) == len(set(urls)) == 6


def test_more_results_than_a_search_has_are_refused(spark):
    with pytest.raises(ValueError):
        O.first_results(V.search_hits(spark, SF), ["campaign", "keyword"], ["hit_pos"], 11)
