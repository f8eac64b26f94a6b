"""Preference pairs as text: the shared turns once as prompt, both endings as masked completions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outpulse.operators.keyed import number_rows
from outpulse.session import store

_SIDES = ("chosen", "rejected")


def preference_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair from rows (pair_id, side, turn, role, text), side ``chosen`` or ``rejected``.

    The prompt is the longest run of first turns that both sides have in role
    and text; ``shared_turns`` is its length. A turn is rendered as
    ``<|role|>`` newline, text, ``<|end|>`` newline; ``<|`` inside a role or
    text becomes ``< |``. ``chosen`` and ``rejected`` hold the rendered turns
    after the prompt, ``*_mask`` their trained spans ``from:to`` in code points
    (end exclusive), comma-joined: texts of assistant turns with their end
    mark. Nothing in the prompt is trained.

    Turns go by turn number, then role, then text; null roles and texts count
    as empty, a null turn number comes first. A side without turns ends empty;
    equal sides give two empty completions. Rows with null pair_id are left
    out. Extra columns are not read.
    """
    clean = {c: F.regexp_replace(F.coalesce(c, F.lit("")), r"<\|", "< |") for c in ("role", "text")}
    place = F.row_number().over(Window.partitionBy("pair_id", "side").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    rows = turns.where("pair_id IS NOT NULL").select(
        "pair_id", "side", "turn", clean["role"].alias("role"), clean["text"].alias("text")
    ).select("*", place.alias("pos"))
    head = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))
    rows = rows.select("pair_id", "side", "pos", "role", head.alias("head"), F.concat(head, "text", F.lit("<|end|>\n")).alias("shown"))

    both = Window.partitionBy("pair_id", "pos")
    same = (F.count("*").over(both) == 2) & (F.min("shown").over(both) == F.max("shown").over(both))
    pair = Window.partitionBy("pair_id")
    first = F.coalesce(F.min(F.when(~F.col("same"), F.col("pos"))).over(pair), F.max("pos").over(pair) + 1)
    rows = rows.withColumn("same", same).withColumn("first", first)

    own = Window.partitionBy("pair_id", "side").orderBy("pos")
    length = F.when(F.col("pos") >= F.col("first"), F.length("shown")).otherwise(0)
    rows = rows.withColumn("at", F.sum(length).over(own) - F.length("shown"))
    span = F.concat((F.col("at") + F.length("head")).cast("string"), F.lit(":"), (F.col("at") + F.length("shown") - 1).cast("string"))
    after = F.col("pos") >= F.col("first")

    def joined(keep, value, between):
        found = F.sort_array(F.collect_list(F.when(keep, F.struct("pos", value.alias("v")))))
        return F.array_join(F.transform(found, lambda x: x["v"]), between)

    sides = {s: F.col("side") == s for s in _SIDES}
    trained = after & (F.col("role") == "assistant")
    return rows.groupBy("pair_id").agg(
        (F.min("first") - 1).cast("long").alias("shared_turns"),
        joined(sides["chosen"] & ~after, F.col("shown"), "").alias("prompt"),
        joined(sides["chosen"] & after, F.col("shown"), "").alias("chosen"),
        joined(sides["chosen"] & trained, span, ",").alias("chosen_mask"),
        joined(sides["rejected"] & after, F.col("shown"), "").alias("rejected"),
        joined(sides["rejected"] & trained, span, ",").alias("rejected_mask"),
    )


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations, as input of :func:`preference_pairs`.

    Chosen is the conversation itself. Rejected is the conversation up to its
    last assistant turn, answered by the last assistant turn of its partner:
    the next conversation in id order that has one, after the last the first.
    A conversation without an assistant turn gives no pair, nor does one that
    is alone in having one. Numbering goes by ranges of ids, so neither task
    nor driver holds them all.
    """
    rows = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text")
    reply = F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))
    last = rows.where("role = 'assistant'").groupBy("conv_id").agg(reply.alias("own"))
    placed = number_rows(last, [], [F.col("conv_id")], "_n", hot_rows=0, largest=1)
    total = placed.count()
    before = F.when(F.col("_n") == 1, F.lit(total)).otherwise(F.col("_n") - 1)
    partner = placed.select(before.alias("_n"), F.col("own.text").alias("answer"))
    matched = placed.select("_n", "conv_id", F.col("own.turn").alias("last_turn")).join(partner, "_n").drop("_n").where(F.lit(total > 1))
    matched = store(matched, "pairs-partners")
    answer = matched.select(
        F.col("conv_id").alias("pair_id"), F.lit("rejected").alias("side"), F.col("last_turn").alias("turn"), F.lit("assistant").alias("role"),
        F.col("answer").alias("text"),
    )
    matched = rows.join(matched, "conv_id")
    chosen = matched.select(F.col("conv_id").alias("pair_id"), F.lit("chosen").alias("side"), "turn", "role", "text")
    kept = matched.where("turn IS NULL OR turn < last_turn").select(F.col("conv_id").alias("pair_id"), F.lit("rejected").alias("side"), "turn", "role", "text")
    return chosen.union(kept).union(answer)


PAIRS_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), last AS (
  SELECT conv_id, max(turn) AS turn FROM rows WHERE role = 'assistant' GROUP BY conv_id
), reply AS (
  SELECT r.conv_id, r.turn, max(coalesce(r.text, '')) AS text
  FROM rows r JOIN last l ON r.conv_id = l.conv_id AND r.turn = l.turn WHERE r.role = 'assistant' GROUP BY ALL
), matched AS (
  SELECT conv_id, turn, coalesce(lead(text) OVER (ORDER BY conv_id), first_value(text) OVER (ORDER BY conv_id)) AS text
  FROM reply QUALIFY count(*) OVER () > 1
), sides AS (
  SELECT r.conv_id AS pair_id, 'chosen' AS side, r.turn, r.role, r.text FROM rows r JOIN matched m USING (conv_id)
  UNION ALL
  SELECT r.conv_id, 'rejected', r.turn, r.role, r.text FROM rows r JOIN matched m USING (conv_id)
  WHERE r.turn IS NULL OR r.turn < m.turn
  UNION ALL
  SELECT conv_id, 'rejected', turn, 'assistant', text FROM matched
), shown AS (
  SELECT pair_id, side, replace(coalesce(role, ''), '<|', '< |') AS role,
         '<|' || replace(coalesce(role, ''), '<|', '< |') || '|>' || chr(10) AS head,
         replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10) AS tail,
         row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, replace(coalesce(role, ''), '<|', '< |'),
                            replace(coalesce(text, ''), '<|', '< |')) AS pos
  FROM sides
), equal AS (
  SELECT pair_id, pos, count(*) = 2 AND min(head || tail) = max(head || tail) AS same FROM shown GROUP BY ALL
), split AS (
  SELECT pair_id, coalesce(min(pos) FILTER (NOT same), max(pos) + 1) AS first FROM equal GROUP BY pair_id
), placed AS (
  SELECT s.*, first, pos >= first AS after,
         sum(CASE WHEN pos >= first THEN length(head || tail) ELSE 0 END) OVER (PARTITION BY pair_id, side ORDER BY pos)
           - length(head || tail) AS spot
  FROM shown s JOIN split USING (pair_id)
)
SELECT pair_id, (min(first) - 1)::BIGINT AS shared_turns,
  coalesce(string_agg(head || tail, '' ORDER BY pos) FILTER (side = 'chosen' AND NOT after), '') AS prompt,
  coalesce(string_agg(head || tail, '' ORDER BY pos) FILTER (side = 'chosen' AND after), '') AS chosen,
  coalesce(string_agg((spot + length(head))::BIGINT || ':' || (spot + length(head || tail) - 1)::BIGINT, ',' ORDER BY pos)
    FILTER (side = 'chosen' AND after AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(head || tail, '' ORDER BY pos) FILTER (side = 'rejected' AND after), '') AS rejected,
  coalesce(string_agg((spot + length(head))::BIGINT || ':' || (spot + length(head || tail) - 1)::BIGINT, ',' ORDER BY pos)
    FILTER (side = 'rejected' AND after AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY pair_id
"""
