import json
from datetime import date

import pytest

from outpulse.sources import landing as L


def landed(spark, *payloads, name="payload"):
    rows = [(n, "k", p if isinstance(p, str) or p is None else json.dumps(p)) for n, p in enumerate(payloads)]
    return spark.createDataFrame(rows, f"n INT, keyword STRING, {name} STRING")


def test_traffic_without_its_array_gives_no_rows(spark):
    point = {"timestamp": "2026-04-01T00:00:00Z", "count": 5, "uniques": 2}
    df = landed(spark, {"count": 5, "uniques": 2, "views": [point]}, {"count": 0, "uniques": 0}, "broken {", None)
    rows = L.read_traffic(df, "views", keep=["n"]).collect()
    assert [tuple(r) for r in rows] == [(0, date(2026, 4, 1), 5, 2, 0)]
    totals = L.read_traffic_totals(df, "views", keep=["n"]).orderBy("n").collect()
    assert [tuple(r) for r in totals] == [(0, 5, 2), (1, 0, 0), (2, 0, 0), (3, 0, 0)]


def test_popular_null_reply_is_empty(spark):
    df = landed(spark, [{"referrer": "a", "count": 1, "uniques": 1}, {"referrer": "b", "count": 2, "uniques": 1}], "null", "[]")
    rows = L.read_popular(df, "referrers", date(2026, 4, 1), keep=["n"]).collect()
    assert [(r.referrer, r.views, r.pos) for r in rows] == [("a", 1, 0), ("b", 2, 1)]


def test_listing_defaults(spark):
    posts = {"data": {"children": [
        {"data": {"created_utc": 1706659200.0, "title": "t", "permalink": "/p", "selftext": "", "url": "http://u", "score": 3}},
        {"data": {"title": "no time"}},
        {"data": {"created_utc": 1706659199}},
    ]}}
    rows = L.read_listing(landed(spark, posts, {}), "post").orderBy("pos").collect()
    assert [(r.title, r.url, r.summary, r.date, r.subreddit, r.score) for r in rows] == [
        ("t", "https://reddit.com/p", "http://u", date(2024, 1, 31), "", 3),
        ("", "https://reddit.com", None, date(2024, 1, 30), "", 0),
    ]
    comment = {"data": {"children": [{"data": {"created_utc": 0, "subreddit": "x", "body": " hi ", "permalink": "/c"}}]}}
    r = L.read_listing(landed(spark, comment), "comment").first()
    assert (r.title, r.subreddit, r.summary, r.sentiment, r.source) == ("Comment in r/x", "r/x", "hi", "neutral", "Reddit")


def test_reply_array(spark):
    fenced = '```json\n[{"url": "u", "date": "2026-04-01"}, {"url": "v", "keyword": "own"}]\n```'
    df = landed(spark, fenced, "not json", '{"url": "w"}', "[]", '[{"url": "x"} and then', name="reply")
    rows = L.parse_reply_array(df, keep=["n"]).orderBy("n", "pos").collect()
    assert [(r.n, r.keyword, r.url, r.asked) for r in rows] == [(0, "k", "u", "k"), (0, "own", "v", "k"), (2, "k", "w", "k")]
    assert rows[0].date == date(2026, 4, 1)


@pytest.mark.parametrize("text, day", [("2026-04-05", date(2026, 4, 5)), ("2026-04-05T10:00:00Z", date(2026, 4, 5)), ("April 5, 2026", None),
                                       ("2026-04", None), ("2026", None), ("2026-02-30", None), ("2026-04-051", None), ("", None), (None, None)])
def test_reply_dates_are_kept_and_none_is_invented(spark, text, day):
    reply = json.dumps([{"url": "u", "date": text}])
    r = L.parse_reply_array(landed(spark, reply, name="reply")).first()
    assert (r.date, r.date_text) == (day, text)


def test_reply_score(spark):
    replies = [
        '{"relevance_score":6,"suggested_comment":"c"}', '{"relevance_score":6,"suggested_comment":" "}',
        '{"relevance_score":5,"suggested_comment":"c"}', '{"relevance_score":"7","suggested_comment":"c"}', "broken",
        '{"relevance_score":7.0,"suggested_comment":" d "}', '{"relevance_score":8}', '{"relevance_score":9} and more',
        '{"relevance_score":null,"suggested_comment":"c"}', None,
    ]
    from outpulse.operators.outreach import qualify

    scored = L.parse_reply_score(landed(spark, *replies, name="reply"))
    assert sorted((r.n, r.relevance_score) for r in scored.collect()) == [(0, 6.0), (1, 6.0), (2, 5.0), (5, 7.0), (6, 8.0)]
    assert sorted((r.n, r.suggested_comment) for r in qualify(scored).collect()) == [(0, "c"), (5, "d")]


def test_threads(spark):
    def thread(post, comments):
        return [{"data": {"children": post}}, {"data": {"children": comments}}]

    good = thread([{"data": {"selftext": " body "}}], [{"kind": "t1", "data": {"body": " a "}}, {"kind": "more", "data": {}}])
    df = landed(spark, good, thread([], []), [{"data": {"children": [{"data": {}}]}}], "oops", thread([{"data": {}}], []))
    rows = L.read_threads(df, keep=["n"]).orderBy("n").collect()
    assert [(r.n, r.selftext, r.comments) for r in rows] == [(0, "body", ["a"]), (4, "", [])]


def test_search_items_defaults(spark):
    df = landed(spark, {"items": [{"link": "l"}, {"title": "t", "snippet": "s"}]}, {})
    rows = L.read_search_items(df).orderBy("pos").collect()
    assert [(r.link, r.title, r.snippet) for r in rows] == [("l", "", ""), ("", "t", "s")]


def test_replies_must_be_one_json_value(spark):
    """Text after the value, a second value and a comment that is no text make a reply unusable."""
    def replies(*texts):
        return spark.createDataFrame([(n, t, "k") for n, t in enumerate(texts)], "n INT, reply STRING, keyword STRING")

    arrays = replies('[{"url":"u1"}] see [1]', '[{"url":"u2"}][{"url":"v"}]', '[{"url":"u3"}]', '```json\n[{"url":"u4"}]\n```')
    assert sorted(r.url for r in L.parse_reply_array(arrays).collect()) == ["u3", "u4"]
    scores = replies('{"relevance_score": 8, "suggested_comment":"x"} or {}', '{"relevance_score": 8, "suggested_comment": 5}',
                     '{"relevance_score": 8, "suggested_comment": null}', '{"relevance_score": 7, "suggested_comment": " y "}',
                     '{"relevance_score": 7}')
    got = L.parse_reply_score(scores).collect()
    assert sorted((r.n, r.suggested_comment) for r in got) == [(3, "y"), (4, "")]
