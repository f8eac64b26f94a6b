import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from outpulse.catalog import views as V
from outpulse.operators import mentions as M

SF = "/root/testdata/sf0.001"


def test_recent_keeps_the_bound(spark):
    df = spark.createDataFrame([(0, 86_400.0), (1, 86_399.9), (2, None)], "n INT, created_utc DOUBLE")
    assert [r.n for r in M.recent(df, 2 * 86_400).collect()] == [0]


@pytest.mark.parametrize("as_table", [False, True])
def test_exclusion(spark, as_table):
    rows = [(0, "Foo AG news", None), (1, "x", None), (2, "t", "on FOO Ag"), (3, "foo", "ag"), (4, None, None)]
    df = spark.createDataFrame(rows, "n INT, title STRING, summary STRING")
    phrases = spark.createDataFrame([("foo ag",)], "phrase STRING") if as_table else ["Foo ag"]
    # The text is title, blank, summary: a phrase may span the two.
    assert sorted(r.n for r in M.exclude_phrases(df, phrases).collect()) == [1, 4]


@pytest.mark.parametrize("shard_bytes", [60_000, M.BROADCAST_BYTES])
def test_phrase_table_equals_substring_search(spark, shard_bytes, monkeypatch):
    """Whole documents against phrases of many lengths, cut anywhere, by the index and by plain search."""
    docs = V.table(spark, SF, "documents").select("doc_id", F.lit("Title").alias("title"), F.col("text").alias("summary"))
    long = "x" * 3000 + "yz" + "w" * 500
    more = [(9000, "Title", None), (9001, "Title", f"{long} end"), (9002, "Title", "a  b"), (9003, "Title", "tail of it")]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    texts = {r.doc_id: f"title {r.summary or ''}".lower() for r in docs.collect()}
    some = sorted(texts.values())
    phrases = {t[-k:] for k, t in zip(range(1, 40), some)} | {t[i * 31 : i * 31 + 9 + i] for i, t in enumerate(some[40:80])}
    phrases = {p for p in phrases if len(p) > 5} | {"title de", "nowhere to be found", "xyzw", "a  b", "ail o", " of it"}
    phrases -= {" " * k for k in range(9)}
    table = spark.createDataFrame([(p.upper() if "ß" not in p else p,) for p in phrases] + [(None,)], "phrase STRING")
    want = sorted(n for n, t in texts.items() if not any(p in t for p in phrases))
    monkeypatch.setattr(M, "BLOCK", 1000)
    got = M.exclude_phrase_table(docs, table, shard_bytes=shard_bytes)
    assert sorted(r.doc_id for r in got.collect()) == want
    assert 0 < len(want) < len(texts)
    plan = plan_of(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


@pytest.mark.parametrize("way", ["rows", "bytes", "index"])
def test_every_size_of_phrase_table_gives_the_same(spark, monkeypatch, way):
    monkeypatch.setattr(M, "INLINE_PHRASES", 2 if way == "index" else 64)
    monkeypatch.setattr(M, "INLINE_BYTES", 5 if way == "bytes" else 65_536)
    df = spark.createDataFrame([(n, f"text {n}", "") for n in range(6)], "n INT, title STRING, summary STRING")
    phrases = spark.createDataFrame([("text 1",), ("XT 3",), ("text 9",), (None,)], "phrase STRING")
    kept = M.exclude_phrases(df, phrases)
    assert sorted(r.n for r in kept.collect()) == [0, 2, 4, 5]
    assert "Python" not in plan_of(kept)
    for blank, left in (("", 0), (" ", 0), ("   ", 4)):
        also = phrases.unionByName(spark.createDataFrame([(blank,)], "phrase STRING"))
        assert M.exclude_phrases(df, also).count() == left


def test_index_takes_the_rarest_inner_word_and_probes_in_the_scan(spark, tmp_path, monkeypatch):
    """Anchors follow the texts' counts; words are looked up by broadcast, and only hits are shuffled."""
    texts = spark.createDataFrame([("common rare the x",)] + [("common the y",)] * 5, "_text STRING")
    listed = spark.createDataFrame([("a common rare the b", ["common", "rare", "the"]), ("a the unseen", ["the"])], "phrase STRING, inner ARRAY<STRING>")
    assert {(r.phrase, r.anchor) for r in M._by_rarest_word(texts, listed).collect()} == {("a common rare the b", "rare"), ("a the unseen", "the")}
    plans = {}

    def recorded(df, name, stored=M.store):
        plans[name] = plan_of(df)
        return stored(df, name)

    monkeypatch.setattr(M, "store", recorded)
    docs = V.table(spark, SF, "documents").select("doc_id", F.col("source").alias("title"), F.col("text").alias("summary"))
    phrases = spark.range(3000).select(F.concat(F.lit("some phrase "), F.col("id"), F.lit(" here")).alias("phrase"))
    assert M.exclude_phrases(docs, phrases).count() == docs.count()
    assert "BroadcastHashJoin" in plans["excluded"] and "SortMergeJoin" not in plans["excluded"]
    assert plans["excluded"].count("Exchange hashpartitioning") == 1  # the hits' distinct


def test_short_phrases_file_nothing_per_word_of_the_texts(spark, monkeypatch):
    """Short phrases are predicates and drop what contains them; the index of the others doesn't grow with the texts' words."""
    stored = {}

    def recorded(df, name, keep=M.store):
        stored[name] = keep(df, name)
        return stored[name]

    monkeypatch.setattr(M, "store", recorded)
    rows = spark.range(2000).select("id", F.concat(F.lit("w"), "id", F.lit("in Ünd"), "id").alias("title"), F.lit(None).cast("string").alias("summary"))
    brands = spark.range(200).select(F.concat(F.lit("Brand"), F.col("id") + 1000).alias("phrase"))
    pairs = spark.range(100).select(F.concat(F.lit("in ünd"), F.col("id") + 1900).alias("phrase"))
    some = spark.createDataFrame([("N ü",), ("7in",), (None,), ("9in ünd19",), ("zz",), (" brand77",), ("a  b",)], "phrase STRING")
    words = {n for n in range(2000) if not str(n).endswith("7")}
    got = M.exclude_phrase_table(rows, brands.unionByName(pairs).unionByName(some.where("phrase <> 'N ü'")))
    assert sorted(r.id for r in got.collect()) == sorted(n for n in words if n < 1900 and not (str(n).endswith("9") and str(n).startswith("19")))
    assert stored["runs"].count() == 305
    stored.clear()
    assert M.exclude_phrases(rows, brands.unionByName(pairs).unionByName(some)).count() == 0
    # "n ü" is among the shortest: the pairs that contain it are not filed.
    assert stored["runs"].where("contains(phrase, 'n ü')").count() == 0 and 0 < stored["runs"].count() <= 200


def test_phrases_of_the_same_frequent_words_are_filed_apart(spark, monkeypatch):
    """Runs of words, not single ones, are looked up, so a text is held against the phrases of its runs only."""
    stored = {}

    def recorded(df, name, keep=M.store):
        stored[name] = keep(df, name)
        return stored[name]

    monkeypatch.setattr(M, "store", recorded)
    runs = [" ".join("on" if n >> k & 1 else "off" for k in range(8)) for n in range(256)]
    phrases = spark.createDataFrame([(f"o {r} n",) for r in runs], "phrase STRING")
    rows = [(n, f"go {r} now" if n % 2 else r, "no off" if n % 4 == 2 else None) for n, r in enumerate(runs)]
    df = spark.createDataFrame(rows, "n INT, title STRING, summary STRING")
    texts = {n: f"{t} {s or ''}" for n, t, s in rows}
    want = sorted(n for n, t in texts.items() if not any(f"o {r} n" in t for r in runs))
    assert 0 < len(want) < 256
    assert sorted(r.n for r in M.exclude_phrase_table(df, phrases).collect()) == want
    assert stored["anchors"].select("gram").distinct().count() == 256


def test_first_per_url(spark):
    rows = [("k1", 1, 1, 1, "u1", "Reddit"), ("k1", 1, 2, 1, "u1", "Blog"), ("k1", 1, 2, 2, "", "Blog"), ("k1", 1, 2, 3, None, "Blog"),
            ("k2", 2, 1, 1, "u1", "Reddit"), ("k2", 2, 2, 1, "u2", "Blog")]
    df = spark.createDataFrame(rows, "keyword STRING, kw_rank INT, src_rank INT, hit_rank INT, url STRING, source STRING")
    once = M.first_per_url(df, by=())
    assert sorted((r.keyword, r.url, r.source) for r in once.collect()) == [("k1", "u1", "Reddit"), ("k2", "u2", "Blog")]
    assert sorted(M.first_per_url(once, by=()).collect()) == sorted(once.collect())


def test_keyword_merge(spark):
    schema = "pos INT, keyword STRING"
    base = spark.createDataFrame([(0, "A"), (1, "a"), (2, "B")], schema)
    extra = spark.createDataFrame([(0, "b"), (1, "C"), (2, "c")], schema)
    got = M.merge_keywords(base, extra).orderBy("origin", "pos").collect()
    assert [r.keyword for r in got] == ["A", "a", "B", "C"]


def test_sentiment_counts(spark):
    df = spark.createDataFrame([("positive",), ("neutral",), (None,), ("mixed",)], "sentiment STRING")
    assert tuple(M.sentiment_counts(df, by=()).first()) == (4, 1, 1, 0)


def test_order_in_source(spark):
    rows = [("a", 0, "Reddit", 2), ("b", 1, "Reddit", 5), ("c", 2, "Reddit", None), ("d", 3, "Reddit", 5), ("e", 4, "Blog", 1), ("f", 5, "Blog", 9)]
    df = spark.createDataFrame(rows, "name STRING, n INT, source STRING, score BIGINT").withColumn("keyword", F.lit("k"))
    for hot in (1000, 2):
        got = M.rank_in_source(df, [F.col("n")], by=(), hot_rows=hot).orderBy("source", "place").collect()
        assert "".join(r.name for r in got) == "efbdac"


def test_counts_tell_subtotals_from_missing_sources(spark):
    df = spark.createDataFrame([("k", None), ("k", "Blog"), (None, "Blog")], "keyword STRING, source STRING").withColumn("score", F.lit(1)).withColumn("sentiment", F.lit("x"))
    got = {(r.keyword, r.source, r.level): r.mentions for r in M.keyword_source_counts(df, by=()).collect()}
    assert got == {("k", "Other", 0): 1, ("k", "Blog", 0): 1, ("unknown", "Blog", 0): 1, ("k", None, 1): 2, ("unknown", None, 1): 1}


def test_icons_and_templates(spark, one):
    assert one(M.source_icon(F.lit("GitHub"))) == ":computer:"
    assert one(M.source_icon(F.lit("Other"))) == ":link:"
    assert one(M.sentiment_icon(F.lit(None).cast("string"))) == ":white_circle:"
    assert one(M.sentiment_icon(F.lit("mixed"))) == ":white_circle:"
    keywords = spark.createDataFrame([("a",), ("b",)], "keyword STRING")
    queries = M.keep_templates(M.expand_queries(keywords, ['"{keyword}" x', " site:reddit.com {keyword}"]), column="query")
    assert sorted(r.query for r in queries.collect()) == ['"a" x', '"b" x']
