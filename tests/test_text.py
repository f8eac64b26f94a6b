from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from outpulse.functions import text as X

c = F.col


def apply(spark, fn, values):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n INT, v STRING")
    return [r.r for r in df.select("n", fn(c("v")).alias("r")).orderBy("n").collect()]


@pytest.mark.parametrize(
    "fn, pairs",
    [
        ("duration", [("135.9", "2m 15s"), ("59", "0m 59s"), ("3600", "60m 0s"), ("abc", "abc"), ("nan", "nan"),
                      ("-61.5", "-2m 59s"), ("1e2", "1m 40s"), ("12d", "12d"), (" 5 ", "0m 5s"), ("inf", "inf"), (None, None)]),
        ("percent", [("0.4231", "42.3%"), ("n/a", "n/a"), ("0.1225", "12.2%"), ("1", "100.0%"), ("0", "0.0%"),
                     ("nan", "nan%"), ("-0.5", "-50.0%"), ("inf", "inf%"), (None, None), ("error", "error")]),
        ("url_base", [("https://x/r/s/comments/1/t/?a=1?b", "https://x/r/s/comments/1/t"), ("https://x/y///", "https://x/y"),
                      ("https://x/y#z", "https://x/y#z")]),
        ("url_segment", [("https://x/r/spark/comments/1", "spark"), ("https://x/y", ""), ("https://x/r/a?b/c", "a?b")]),
        ("title_clean", [(" How to dedupe - Reddit ", "How to dedupe"), ("a - Reddit - Reddit", "a")]),
        ("snippet", [("a" * 140, "a" * 140), ("a" * 141, "a" * 140 + "...")]),
        ("label_tail", [("p" * 40, "p" * 40), ("x" + "p" * 40, "..." + "p" * 37)]),
        ("ws_trim", [("\t a \n", "a"), ("　\xa0b\x1c", "b"), ("", ""), (None, None)]),
        ("strip_fence", [("```json\n[1]\n```", "[1]"), (" ```\n[2]``` tail", "[2]"), (" [3] ", "[3]"), ("```", ""),
                         ("```jsonx```", "x")]),
    ],
)
def test_text_functions(spark, fn, pairs):
    assert apply(spark, getattr(X, fn), [v for v, _ in pairs]) == [want for _, want in pairs]


def test_whitespace_is_what_python_strips():
    assert sorted(X.WHITESPACE) == [chr(i) for i in range(0x10000) if chr(i).isspace()]


def test_percent_rounds_like_the_exact_binary_value(spark):
    values = [n / 800 for n in range(0, 4000)] + [n / 1000 + 1e-9 for n in range(500)] + [0.125, 0.375, 3.3e-5, 5e-4, 1.0005]
    df = spark.createDataFrame([(float(v),) for v in values], "v DOUBLE")
    for r in df.select("v", X.percent(c("v")).alias("p")).collect():
        assert r.p == f"{r.v * 100:.1f}%", r
        assert abs(Fraction(r.p[:-1]) - Fraction(r.v * 100)) <= Fraction(1, 20)


def test_summary_and_snippet(spark):
    df = spark.createDataFrame(
        [(0, "", "http://u"), (1, "a" * 300, None), (2, "  ", None), (3, None, None), (4, "é😀" * 150, None)],
        "n INT, t STRING, u STRING",
    )
    got = [r.s for r in df.select("n", X.summary(c("t"), c("u")).alias("s")).orderBy("n").collect()]
    assert got == ["http://u", "a" * 200, None, None, "é😀" * 100]


def test_title_and_body_fallback(spark):
    df = spark.createDataFrame([(0, "(not set)", "/a"), (1, "A", "/a"), (2, None, "/a")], "n INT, t STRING, p STRING")
    got = [r.v for r in df.select("n", X.title_fallback(c("t"), c("p")).alias("v")).orderBy("n").collect()]
    assert got == ["/a", "A", None]
    rows = [(0, "[removed]", "s"), (1, " ", "s"), (2, "b" * 3000, "s"), (3, None, None), (4, "[deleted]", "t" * 2500)]
    df = spark.createDataFrame(rows, "n INT, b STRING, s STRING")
    got = [r.v for r in df.select("n", X.body_fallback(c("b"), c("s")).alias("v")).orderBy("n").collect()]
    assert got == ["s", "s", "b" * 2000, "", "t" * 2000]


def test_comments_and_bullets(spark):
    rows = [[("t1", " a "), ("more", "b"), ("t1", "[deleted]"), ("t1", ""), ("t1", None), *[("t1", x) for x in "cdefgh"]], [], None]
    df = spark.createDataFrame([(n, r) for n, r in enumerate(rows)], "n INT, raw ARRAY<STRUCT<kind: STRING, body: STRING>>")
    got = df.select("n", X.clean_comments(c("raw")).alias("v")).withColumn("b", X.bullets(c("v"))).orderBy("n").collect()
    assert [r.v for r in got] == [["a", "c", "d", "e", "f"], [], []]
    assert [r.b for r in got] == ["- a\n- c\n- d\n- e\n- f", "(no comments)", "(no comments)"]


def test_template_marks_in_inserted_text_stay(one):
    got = one(X.fill_template("{a}-{b}-{c}", {"a": F.lit("{b}"), "b": F.lit("x")}))
    assert got == "{b}-x-{c}"


def test_link_parts_plural_thousands(one):
    assert one(X.link_has(F.lit("https://www.reddit.com/r/x/comments/1")))
    assert not one(X.link_has(F.lit("https://www.reddit.com/r/x")))
    assert [one(X.plural(F.lit(n))) for n in (0, 1, 2)] == ["s", "", "s"]
    assert one(X.thousands(F.lit(1234567))) == "1,234,567"
