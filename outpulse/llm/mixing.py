"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 60-bit hash. Words are summed by source and hash bucket;
running sums over a source's buckets show which one crosses its budget; only
that bucket is split again by the next bits, until it holds one hash. A
document is taken if its hash lies below its source's threshold: a filter, no
sort, and the same documents in every rerun.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.operators.keyed import join_lookup, number_rows
from outpulse.session import store

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, LEVEL_BITS = 60, 12
MOST = 3
PLANNED = ("source_size", "target", "whole", "cut", "last")


def hash60(*columns: str) -> Column:
    """The first 60 bits of the MD5 of the values, joined by ``:``; null counts as empty."""
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target) from (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share
    the sum of all sizes; a target stops at ``most`` times its source's size
    and the excess goes to the others by weight. One row per source is kept in
    Spark; only sums come to the driver.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = number_rows(sources, [], [F.col("source").asc_nulls_last()], "_rank")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") - 1).cast("int") % len(weights) + 1)
    ranked = store(ranked.select("source", "source_size", turn.cast("long").alias("weight")), "mix-sources")
    cap = F.col("source_size") * most
    level = 0.0
    while True:
        above = cap.cast("double") < F.lit(level) * F.col("weight")
        total, capped, free = ranked.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if not free or (total - capped) / free == level:
            break
        level = (total - capped) / free
    share = cap.cast("double") if not free else F.least(cap.cast("double"), F.lit(level) * F.col("weight"))
    return ranked.withColumn("target", share)


def thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, cut, last): hashes below ``cut`` are taken, and ``cut`` itself if ``last``.

    ``docs`` is (source, size, h), ``budgets`` (source, budget) with budgets
    below the source's size. The taken sum misses the budget by at most half
    the words of one hash.
    """
    named = F.coalesce(F.col("source"), F.lit("")).alias("_s"), F.col("source").isNull().alias("_n")
    rows = docs.where("size > 0").select(*named, "size", "h")
    state = budgets.select(*named, "budget", F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("prefix"))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = join_lookup(rows, state, ["_s", "_n"]).where(
            F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix")
        )
        buckets = inside.groupBy("_s", "_n", "budget", "before", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi")
        )
        order = Window.partitionBy("_s", "_n").orderBy("bucket")
        upto = F.col("before") + F.sum("words").over(order)
        state = store(
            buckets.withColumn("upto", upto)
            .where((F.col("upto") > F.col("budget")) & (F.col("upto") - F.col("words") <= F.col("budget")))
            .select("_s", "_n", "budget", (F.col("upto") - F.col("words")).alias("before"), F.col("bucket").alias("prefix"),
                    "words", "lo", "hi"), "mix-level",
        )
        if state.where("lo < hi").isEmpty():
            break
        if shift:
            state = state.drop("words", "lo", "hi")
    last = F.col("before") + F.col("words") / 2 <= F.col("budget")
    return state.select(F.when(~F.col("_n"), F.col("_s")).alias("source"), F.col("lo").alias("cut"), last.alias("last"))


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    count = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    return docs.withColumn("_seed", F.lit(seed)).withColumns({"_size": count, "_h": hash60("_seed", "doc_id", "text")}).drop("_seed")


def plan(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row per source of (source, size, h): its size and target, and which hashes are taken how often."""
    full = targets(sizes, weights).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    )
    full = store(full.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    cuts = thresholds(sizes, full.where("budget > 0").select("source", "budget"))
    found = full.join(cuts, full["source"].eqNullSafe(cuts["source"]), "left").select(
        F.coalesce(full["source"], F.lit("")).alias("_s"), full["source"].isNull().alias("_n"), "source_size", "target",
        "whole", "cut", "last",
    )
    return store(found, "mix-plan")


def _taken(rows: DataFrame, planned: DataFrame, h: str) -> DataFrame:
    """``rows`` with the plan's columns and ``copies``, all with a leading ``_``: the rows may have any others."""
    rows = rows.withColumns({"_s": F.coalesce("source", F.lit("")), "_n": F.col("source").isNull()})
    planned = planned.withColumnsRenamed({c: f"_{c}" for c in PLANNED})
    once_more = F.coalesce((F.col(h) < F.col("_cut")) | ((F.col(h) == F.col("_cut")) & F.col("_last")), F.lit(False))
    return join_lookup(rows, planned, ["_s", "_n"]).withColumn("_copies", (F.col("_whole") + once_more.cast("long")).cast("long"))


def mix(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) for every row of ``docs`` (doc_id, text, source).

    ``size`` counts words (null text: 0). A source whose target is n times its
    size plus a rest gives every document n times, and once more those whose
    hash of seed, doc_id and text lies below the threshold of the rest; no more
    than three times altogether. Rows equal in doc_id and text go together. A
    null source is a source of its own; sources without words have target 0;
    an empty table gives no rows.
    """
    rows = store(_sized(docs, seed).select("doc_id", "source", F.col("_size").alias("size"), F.col("_h").alias("h")), "mix-sizes")
    taken = _taken(rows, plan(rows, weights), "h").withColumnsRenamed({f"_{c}": c for c in ("source_size", "target", "copies")})
    return taken.select("doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``docs``' rows that the mix of :func:`mix` takes, with ``copies``, how often; the texts are not shuffled.

    Rows keep all their columns, whatever their names, but one named
    ``copies``, which is replaced. Nulls, repeated rows and sources without
    words are as in :func:`mix`; an empty table gives no rows.
    """
    rows = _sized(docs, seed)
    sizes = store(rows.select("source", F.col("_size").alias("size"), F.col("_h").alias("h")), "mix-sizes")
    taken = _taken(rows, plan(sizes, weights), "_h")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "copies"]
    return taken.where("_copies > 0").select(*kept, F.col("_copies").alias("copies"))


#: The same mix for DuckDB, from a table ``{docs}`` with doc_id, text and source.
MIX_SQL = r"""
sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM {docs}
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM sized GROUP BY source
), steps AS (
  SELECT *, (3 * source_size)::DOUBLE / weight AS ratio,
         row_number() OVER (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST) AS place,
         coalesce(sum(3 * source_size) OVER before, 0) AS capped,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free
  FROM sources
  WINDOW before AS (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT arg_min(((SELECT sum(source_size) FROM sources) - capped)::DOUBLE / free::DOUBLE, place) AS level
  FROM steps WHERE ((SELECT sum(source_size) FROM sources) - capped)::DOUBLE / free::DOUBLE <= ratio
), aimed AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, coalesce(level * weight, 'infinity'::DOUBLE)) AS target
  FROM sources, levels
), planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM aimed
), hashed AS (
  SELECT source, h, sum(size) AS words FROM sized WHERE size > 0 GROUP BY ALL
), summed AS (
  SELECT hashed.*, sum(words) OVER (PARTITION BY source ORDER BY h) - words AS before FROM hashed
), cut AS (
  SELECT s.source, max(s.h) AS h
  FROM summed s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
  WHERE s.before + s.words / 2.0 <= p.target - p.whole * p.source_size AND p.target - p.whole * p.source_size > 0
  GROUP BY s.source
), mixed AS (
  SELECT d.doc_id, d.size, p.source_size, p.target,
         p.whole + coalesce((d.h <= c.h)::BIGINT, 0) AS copies
  FROM sized d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source
  LEFT JOIN cut c ON d.source IS NOT DISTINCT FROM c.source
)"""
