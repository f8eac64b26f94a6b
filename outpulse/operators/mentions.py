"""Mentions: age and exclusion filters, union and dedupe, counts, ranking."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpulse.functions import dates as D
from outpulse.functions import text as X
from outpulse.operators.keyed import BROADCAST_BYTES, BROADCAST_ROWS, first_per_key, join_lookup, number_rows
from outpulse.session import store

INLINE_PHRASES, INLINE_BYTES = 64, 65_536
SAMPLE_TEXTS = 10_000
SAMPLE_BLOCKS = 500
SHARDS_A_JOB = 4
BLOCK = 16_384
ANCHORS = (1, 2, 4, 8, 16)
WORDS = (1, 2, 4, 8)

# Icons of sentiments and sources.
SENTIMENT_ICONS = {
    "positive": ":large_green_circle:",
    "neutral": ":white_circle:",
    "negative": ":red_circle:",
}
SOURCE_ICONS = {
    "github": ":computer:",
    "reddit": ":speech_balloon:",
    "hackernews": ":orange_book:",
    "twitter": ":bird:",
    "linkedin": ":briefcase:",
    "youtube": ":movie_camera:",
    "blog": ":memo:",
    "medium": ":memo:",
    "news": ":newspaper:",
}
RANKED_SOURCE = "Reddit"


def recent(df: DataFrame, as_of: int, days: int = 1, created: str = "created_utc") -> DataFrame:
    """Rows created at most ``days`` before ``as_of`` (both epoch seconds); the bound itself stays."""
    return df.where(F.col(created) >= as_of - days * D.DAY)


def has_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Rows with a URL that is neither missing nor empty."""
    return df.where(X.has_text(F.col(url)))


def _search_text(columns: Sequence[str]) -> Column:
    return X.folded(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))


def exclude_phrases(
    df: DataFrame, phrases: Sequence[str] | DataFrame, columns: Sequence[str] = ("title", "summary")
) -> DataFrame:
    """Drop rows whose lower-cased text contains any phrase.

    A phrase list, or a phrase table of up to 64 rows and 64 KB, becomes one
    predicate per phrase inside the scan stage. Of a larger table the shortest
    phrases without inner words, for which an index is dearest, do; phrases that
    contain one of them can't decide any more and are left out. What remains
    goes through :func:`exclude_phrase_table` if it is still too large.
    """
    text = _search_text(columns)
    if isinstance(phrases, DataFrame):
        table = _distinct_phrases(phrases)
        if not _inline(table):
            table = store(table, "phrases")
            short = _shortest(table)
            df, table = _without(df, text, short), _without(table, F.col("phrase"), short)
            if not _inline(table):
                return exclude_phrase_table(df, table, columns)
        phrases = [r.phrase for r in table.limit(INLINE_PHRASES).collect()]
    return _without(df, text, [p.lower() for p in phrases])


def _without(df: DataFrame, text: Column, phrases: Sequence[str]) -> DataFrame:
    """Rows whose ``text``, made once a row, contains none of a few phrases."""
    if not phrases:
        return df
    found = F.exists(F.array(text), lambda t: reduce(lambda a, b: a | b, [F.contains(t, F.lit(p)) for p in phrases]))
    return df.where(~found)


def _inline(table: DataFrame) -> bool:
    n, size = table.limit(INLINE_PHRASES + 1).agg(F.count("*"), F.coalesce(F.sum(F.octet_length("phrase")), F.lit(0))).first()
    return n <= INLINE_PHRASES and size <= INLINE_BYTES


def _shortest(table: DataFrame) -> list[str]:
    """The shortest phrases without inner words, as many as may be predicates."""
    size = F.octet_length("phrase")
    few = table.where(~_has_inner("phrase") & (size <= INLINE_BYTES // INLINE_PHRASES)).orderBy(size, "phrase")
    return [r.phrase for r in few.limit(INLINE_PHRASES).collect()]


def _inner(phrase: str) -> Column:
    """What stands between a phrase's first and last blank, split at blanks."""
    parts = F.split(phrase, " ")
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))


def _has_inner(phrase: str) -> Column:
    return F.exists(_inner(phrase), lambda w: w != "")


def _distinct_phrases(phrases: DataFrame) -> DataFrame:
    return phrases.where("phrase IS NOT NULL").select(X.folded(F.col("phrase")).alias("phrase")).distinct()


def _words(text: Column | str) -> Column:
    return F.array_distinct(F.split(text, " "))


def exclude_phrase_table(
    df: DataFrame, phrases: DataFrame, columns: Sequence[str] = ("title", "summary"), shard_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The same filter for a phrase table of any size, by an index of anchors.

    A text that contains a phrase has each of the phrase's inner words, those
    with a blank on both sides, as a word of its own. The anchor of a phrase
    is the inner word that the fewest texts of a sample have, and it is filed
    under a run of 1, 2, 4 or 8 inner words with the anchor. A phrase without
    inner words is filed under one of its runs of 1, 2, 4, 8 or 16 characters.
    Texts are split inside the scan and looked up in the index there, in
    shards that each are small enough to broadcast; a phrase that meets its
    run is compared at that place. So only the keys of texts that hit leave
    the scan, and the index has one row per phrase, whatever the texts.
    """
    text = _search_text(columns)
    has_inner, has_part = F.size("inner") > 0, F.trim("phrase") != ""
    listed = store(_distinct_phrases(phrases).select("phrase", F.filter(_inner("phrase"), lambda w: w != "").alias("inner")), "phrases")
    blank, plain, short, longest = listed.agg(
        F.min(F.when(~has_part, F.length("phrase"))), F.count_if(has_inner), F.count_if(~has_inner & has_part),
        F.max(F.when(~has_inner, F.length("phrase"))),
    ).first()
    if blank is not None:
        # Of phrases of blanks alone, the shortest decides.
        df = df.where(~F.contains(text, F.lit(" " * blank)))
    texts = df.select(text.alias("_text"))
    met = []
    if plain:
        words = texts.select(F.sha2("_text", 256).alias("_text_key"), F.split("_text", " ").alias("_units"))
        index = store(_by_words(_by_rarest_word(texts, listed.where(has_inner))), "anchors")
        shards, widths = _even_shards(index, shard_bytes)
        met += [_holding(words, " ", widths, shard) for shard in shards]
    if short:
        blocks = _blocks(texts, longest)
        index = store(_by_rarest_run(blocks, listed.where(~has_inner & has_part)), "runs")
        shards, widths = _even_shards(index, shard_bytes)
        met += [_holding(blocks, "", widths, shard) for shard in shards]
    if not met:
        return df

    # Every shard is a pass over the texts; a few of them at a time keep the plan small.
    passes = [met[i : i + SHARDS_A_JOB] for i in range(0, len(met), SHARDS_A_JOB)]
    hits = [store(reduce(lambda a, b: a.unionByName(b), some).distinct(), "excluded") for some in passes]
    hit = reduce(lambda a, b: a.unionByName(b), hits).distinct() if len(hits) > 1 else hits[0]
    return join_lookup(df.withColumn("_text_key", F.sha2(text, 256)), hit, ["_text_key"], "left_anti").drop("_text_key")


def _even_shards(index: DataFrame, most: int) -> tuple[list[DataFrame], list[int]]:
    """The index split by hash to parts that each fit a broadcast, a longer phrase being a part of its own; the runs' widths."""
    width = F.octet_length("phrase") + 96
    shards = 1
    while True:
        shard = F.pmod(F.xxhash64("gram", "phrase"), F.lit(shards))
        rows, largest, single, widths = index.groupBy(shard).agg(
            F.count("*").alias("n"), F.sum(width).alias("size"), F.max(width).alias("one"), F.collect_set("width").alias("widths")
        ).agg(
            F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0)), F.coalesce(F.max("one"), F.lit(0)),
            F.array_distinct(F.flatten(F.collect_list("widths"))),
        ).first()
        if rows <= BROADCAST_ROWS and largest <= max(most, single):
            return [index.where(shard == i) for i in range(shards)], widths
        shards = max(2 * shards, -(-largest // most))


def _by_rarest_word(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """(anchor, phrase) with the inner word that the fewest of the first texts have; a sample changes only the cost."""
    inner = phrases.select("phrase", F.explode("inner").alias("anchor"))
    sampled = texts.limit(SAMPLE_TEXTS).select(F.explode(_words("_text")).alias("anchor")).groupBy("anchor").agg(F.count("*").alias("n"))
    counted = inner.join(sampled, "anchor", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return counted.groupBy("phrase").agg(F.min(F.struct("n", "anchor"))["anchor"].alias("anchor")).select("anchor", "phrase")


def _by_words(anchors: DataFrame) -> DataFrame:
    """(gram, width, before, size, phrase) with a run of inner words around each phrase's anchor."""
    inner = _inner("phrase")
    width = reduce(lambda a, n: F.when(F.size("inner") >= n, n).otherwise(a), WORDS[1:], F.lit(WORDS[0]))
    sized = anchors.withColumn("inner", inner).withColumn("width", width)
    # Runs are cut at the anchor or, too near the end for that, as late as they fit.
    before = F.least(F.array_position("inner", F.col("anchor")).cast("int"), F.size("inner") - F.col("width") + 1)
    gram = F.xxhash64(F.slice("inner", F.col("before"), F.col("width"))).alias("gram")
    return sized.withColumn("before", before).select(gram, "width", "before", (F.size("inner") + 2).alias("size"), "phrase")


def _blocks(texts: DataFrame, longest: int) -> DataFrame:
    """Texts cut to blocks of characters that overlap by the longest phrase, so that each place of a phrase is whole in one."""
    step = max(BLOCK, longest)
    keyed = texts.select(F.sha2("_text", 256).alias("_text_key"), F.col("_text").alias("part"))
    return _cut(keyed, ["_text_key"], "block", step, longest).select("_text_key", F.split("part", "").alias("_units"))


def _by_rarest_run(blocks: DataFrame, phrases: DataFrame) -> DataFrame:
    """(gram, width, before, size, phrase) with the run of characters that is rarest in the first blocks; these change only the cost."""
    size, chars = F.length("phrase"), F.split("phrase", "")
    width = reduce(lambda a, n: F.when(size >= n, n).otherwise(a), ANCHORS[1:], F.lit(ANCHORS[0]))
    sized = phrases.select("phrase", chars.alias("chars"), size.alias("size"), width.alias("width"))
    runs = sized.withColumn("before", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("width"))))
    runs = runs.select(F.xxhash64(F.slice("chars", F.col("before") + 1, F.col("width"))).alias("gram"), "width", "before", "size", "phrase")
    sampled = _grams(blocks.limit(SAMPLE_BLOCKS), ANCHORS).groupBy("gram").agg(F.count("*").alias("n"))
    counted = runs.join(sampled, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    first = F.min(F.struct("n", "before", "gram", "width", "size")).alias("run")
    return counted.groupBy("phrase").agg(first).select("run.gram", "run.width", "run.before", "run.size", "phrase")


def _grams(units: DataFrame, widths: Sequence[int]) -> DataFrame:
    """The runs of ``widths`` units from every place of ``_units``, as hashes ``gram``, with the place ``_at`` from 0."""
    placed = units.select("*", F.posexplode("_units").alias("_at", "_unit"))
    grams = [F.xxhash64(F.slice("_units", F.col("_at") + 1, F.lit(n))) for n in widths]
    return placed.select(*units.columns, "_at", F.explode(F.array(*grams)).alias("gram"))


def _holding(units: DataFrame, blank: str, widths: Sequence[int], index: DataFrame) -> DataFrame:
    """Keys of texts that hold a phrase of the index, which is compared where its run stands and nowhere else."""
    first = F.greatest(F.col("_at") + 1 - F.col("before"), F.lit(1))
    there = F.array_join(F.slice("_units", first, F.col("size")), blank)
    return _grams(units, widths).join(F.broadcast(index), "gram").where(F.contains(there, "phrase")).select("_text_key")


def _cut(df: DataFrame, keep: Sequence[str], name: str, size: int, overlap: int) -> DataFrame:
    """Texts in column ``part`` cut to overlapping parts, numbered as ``name``."""
    offsets = F.sequence(F.lit(1), F.greatest(F.length("part"), F.lit(1)), F.lit(size))
    cut = df.select(*keep, "part", F.posexplode(offsets).alias(name, "_offset"))
    return cut.withColumn("part", F.col("part").substr(F.col("_offset"), F.lit(size + overlap))).drop("_offset")


def keep_templates(df: DataFrame, skip: Sequence[str] = ("site:reddit.com",), column: str = "template") -> DataFrame:
    """Query templates that start with none of the given prefixes."""
    bare = X.ws_trim(F.col(column))
    for prefix in skip:
        df = df.where(~F.startswith(bare, F.lit(prefix)))
    return df


def expand_queries(keywords: DataFrame, templates: Sequence[str], keyword: str = "keyword") -> DataFrame:
    """One query per keyword and template; the template list is a short literal, so nothing is joined."""
    marks = F.array(*[F.lit(t) for t in templates])
    rows = keywords.select("*", F.posexplode(marks).alias("template_pos", "template"))
    return rows.withColumn("query", F.replace("template", F.lit("{keyword}"), F.col(keyword))).drop("template")


def with_defaults(mentions: DataFrame) -> DataFrame:
    """Defaults for missing fields as the listing shows them; the icon sentiment is kept apart."""
    return (
        mentions.withColumn("keyword", F.coalesce("keyword", F.lit("unknown")))
        .withColumn("source", F.coalesce("source", F.lit("Other")))
        .withColumn("score", F.coalesce("score", F.lit(0)))
        .withColumn("icon_sentiment", F.coalesce("sentiment", F.lit("neutral")))
    )


def lookup_icon(value: Column, icons: dict[str, str], default: str) -> Column:
    """Constant lookup with a default."""
    table = F.create_map(*[F.lit(x) for pair in icons.items() for x in pair])
    return F.coalesce(F.try_element_at(table, value), F.lit(default))


def sentiment_icon(sentiment: Column) -> Column:
    return lookup_icon(F.coalesce(sentiment, F.lit("neutral")), SENTIMENT_ICONS, ":white_circle:")


def source_icon(source: Column) -> Column:
    return lookup_icon(X.folded(source), SOURCE_ICONS, ":link:")


def listed(mentions: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Mentions of configured keywords with the keyword's place in the list as ``list_rank``."""
    ranks = mentions.sparkSession.createDataFrame(list(enumerate(keywords, 1)), "list_rank INT, keyword STRING")
    return join_lookup(mentions, ranks, ["keyword"], rows=len(keywords))


def union_sources(reddit: DataFrame, web: DataFrame) -> DataFrame:
    """Union of rows with different columns; missing ones are NULL."""
    return reddit.unionByName(web, allowMissingColumns=True)


def first_per_url(
    mentions: DataFrame,
    by: Sequence[str] = ("monitor",),
    order_by: Sequence[str | Column] = ("kw_rank", "src_rank", "hit_rank"),
) -> DataFrame:
    """First mention of every URL in arrival order; rows without a URL are dropped."""
    return first_per_key(has_url(mentions), [*by, "url"], order_by)


def merge_keywords(base: DataFrame, extra: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Keyword list with extras: the base stays as it is, an extra joins once if new in any letter case.

    Both tables are ``(*by, pos, keyword)``; the result's ``origin`` is 0 for
    the base and 1 for extras.
    """
    tagged = base.withColumn("origin", F.lit(0)).unionByName(extra.withColumn("origin", F.lit(1)))
    tagged = tagged.withColumn("_folded", X.folded(F.col("keyword")))
    # The first row per folded keyword comes from the base if the base has it.
    first = first_per_key(tagged, [*by, "_folded"], ["origin", "pos", "keyword"])
    added = first.where("origin = 1").drop("_folded")
    return tagged.where("origin = 0").drop("_folded").unionByName(added)


def sentiment_counts(mentions: DataFrame, by: Sequence[str] = ("monitor",)) -> DataFrame:
    """Totals; an unknown or missing sentiment counts in the total only."""
    named = {s: F.count_if(F.col("sentiment") == s).alias(s) for s in ("positive", "neutral", "negative")}
    return mentions.groupBy(*by).agg(F.count("*").alias("total"), *named.values())


def keyword_source_counts(mentions: DataFrame, by: Sequence[str] = ("monitor",)) -> DataFrame:
    """Counts per keyword and source and per keyword (``level`` 0 and 1).

    The rollup runs over the folded counts, so raw rows are not multiplied.
    """
    folded = with_defaults(mentions).groupBy(*by, "keyword", "source").agg(F.count("*").alias("n"))
    rolled = folded.rollup(*by, "keyword", "source").agg(
        F.sum("n").alias("mentions"), F.grouping_id().alias("level")
    )
    return rolled.where(F.col("level") <= 1)


def source_order(source: Column, score: Column) -> Column:
    """Sort key inside a keyword and source: ranked sources by score, the others as they came."""
    return F.when(source == RANKED_SOURCE, -F.coalesce(score, F.lit(0))).otherwise(F.lit(0))


def rank_in_source(
    mentions: DataFrame, arrival: Sequence[Column], by: Sequence[str] = ("monitor",), **options
) -> DataFrame:
    """Place of every mention inside its keyword and source.

    Numbering looks at its input twice, so mentions are written once before
    unless the caller knows the ``largest`` group.
    """
    keyed = mentions.withColumn("_order", source_order(F.col("source"), F.col("score")))
    if options.get("largest") is None:
        keyed = store(keyed, "ranked")
    order = [F.col("_order"), *arrival]
    return number_rows(keyed, [*by, "keyword", "source"], order, "place", **options).drop("_order")
