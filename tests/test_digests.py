from datetime import date

from pyspark.sql import functions as F

from outpulse.plans import digests as G

MENTIONS = (
    "monitor STRING, kw_rank INT, src_rank INT, hit_rank INT, keyword STRING, title STRING, url STRING, source STRING, "
    "summary STRING, sentiment STRING, date DATE, subreddit STRING, score BIGINT"
)
DAY = date(2026, 4, 5)
ROWS = [
    ("m", 1, 1, 1, "b", "T1", "u1", "Reddit", "s" * 141, "neutral", DAY, "r/x", 2),
    ("m", 1, 1, 2, "b", "T2", "u2", "Reddit", None, "neutral", DAY, "", 5),
    ("m", 1, 2, 1, "b", "T3", "u3", "Blog", "short", "positive", None, None, None),
    ("m", 2, 2, 1, "a", "T4", "u4", "Elsewhere", "", None, DAY, None, 0),
    ("m", 3, 2, 1, "zz", "T5", "u5", "Blog", None, "negative", DAY, None, None),
]
TEXT = f"""*Web Mentions — Apr 05, 2026*
_keywords: a, b, c · 5 mentions · :large_green_circle: 1  :white_circle: 2  :red_circle: 1_

*a* — 1 mention
:link: *Elsewhere* (1)
  :white_circle: <u4|T4>  _2026-04-05_

*b* — 3 mentions
:memo: *Blog* (1)
  :large_green_circle: <u3|T3>
    _short_
:speech_balloon: *Reddit* (2)
  :white_circle: <u2|T2> ↑5  _2026-04-05_
  :white_circle: <u1|T1> [r/x] ↑2  _2026-04-05_
    _{"s" * 140}..._"""


def test_mention_digest_text(spark):
    df = spark.createDataFrame(ROWS, MENTIONS)
    for options in ({}, {"hot_rows": 3}):
        lines = G.mention_digest(df, ["a", "b", "c"], "Apr 05, 2026", **options)
        assert [r.message for r in G.messages(lines, ["monitor"]).collect()] == [TEXT]
        parts = G.messages(lines, ["monitor"], size=4).orderBy("part").collect()
        assert len(parts) > 2 and "\n".join(r.message for r in parts) == TEXT


def test_a_monitor_without_mentions_says_so(spark):
    tenants = spark.createDataFrame([("m",), ("quiet",)], "monitor STRING")
    lines = G.mention_digest(spark.createDataFrame(ROWS, MENTIONS), ["a", "b", "c"], "Apr 05, 2026", tenants=tenants)
    text = {r.monitor: r.message for r in G.messages(lines, ["monitor"]).collect()}
    assert text["m"] == TEXT
    assert text["quiet"] == (
        "*Web Mentions — Apr 05, 2026*\n_keywords: a, b, c · 0 mentions · :large_green_circle: 0  :white_circle: 0  "
        ":red_circle: 0_\n\nNo relevant mentions found today."
    )


def test_repo_digest_omits_empty_sections(spark):
    info = spark.createDataFrame([("o/r", DAY, 1234, 5, 6, 7), ("o/s", DAY, 1, 1, 1, 1)],
                                 "repo STRING, date DATE, stars BIGINT, forks BIGINT, watchers BIGINT, open_issues BIGINT")
    totals = spark.createDataFrame([("o/r", 10, 1000)], "repo STRING, count BIGINT, uniques BIGINT")
    refs = spark.createDataFrame([("o/r", "x", 5, 4, 0), ("o/r", "a", 6, 1, 1)],
                                 "repo STRING, referrer STRING, views BIGINT, unique_visitors BIGINT, pos INT")
    paths = refs.withColumnRenamed("referrer", "path").limit(0)
    lines = G.repo_digest(info, totals, totals.limit(0), refs, paths, DAY, "https://b")
    text = {r.repo: r.message for r in G.messages(lines, ["repo"]).collect()}
    links = " · ".join(f"<https://b/{k}/{k}_2026_04.csv|{k.replace('_', ' ')}>" for k in ("views", "clones", "referrers", "paths", "repo_stats"))
    assert text["o/r"] == f"""*GitHub Stats — Apr 05, 2026*
_<https://github.com/o/r|o/r>_

*Repository Overview*
• Stars: *1,234*
• Forks: *5*
• Watchers: *6*
• Open Issues: *7*

*Traffic — Last 14 Days*
• Page Views: *10* (1,000 unique)
• Git Clones: *0* (0 unique)

*Top Referrers*
• x: 5 views (4 unique)
• a: 6 views (1 unique)

*CSV Archive (2026_04)*
{links}"""
    assert "Top Referrers" not in text["o/s"]


def test_opportunity_digest(spark):
    results = spark.createDataFrame([("c", 0, 1, 0, "T2", "u2", "say 2"), ("c", 0, 0, 3, "T1", "u1", "say 1")],
                                    "campaign STRING, batch_pos INT, kw_pos INT, hit_pos INT, title STRING, url STRING, suggested_comment STRING")
    runs = spark.createDataFrame([("c", [9, 10]), ("d", [1, 2])], "campaign STRING, batches ARRAY<INT>")
    lines = G.opportunity_digest(results, runs, DAY)
    text = {r.campaign: r.message for r in G.messages(lines, ["campaign"]).collect()}
    assert text["d"] == "Reddit Digest - April 05, 2026\nNo qualifying posts found today."
    assert text["c"] == (
        "*Reddit Digest - April 05, 2026*\nBatches: [9, 10]  |  Posts found: *2*\n"
        "*1. T1*\n<u1|View Post on Reddit>\n\n*Suggested Comment:*\nsay 1\n"
        "*2. T2*\n<u2|View Post on Reddit>\n\n*Suggested Comment:*\nsay 2"
    )
    payload = G.digest_payload(G.messages(lines, ["campaign"]), ["campaign"], "ch").where(F.col("campaign") == "d").first()
    assert '"channel":"ch"' in payload.payload and '"mrkdwn":true' in payload.payload


def test_mention_dates_are_shown_as_written(spark):
    df = spark.createDataFrame(ROWS[2:4], MENTIONS).withColumn("date_text", F.when(F.col("url") == "u3", "April 5, 2026"))
    lines = [r.line for r in G.mention_digest(df, ["a", "b"], "x").collect()]
    assert "  :large_green_circle: <u3|T3>  _April 5, 2026_" in lines and any("_2026-04-05_" in x for x in lines)
