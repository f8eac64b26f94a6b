"""Merkle manifest of a table, its levels kept as concatenated strings.

Leaves are numbered inside their group and cut into aligned blocks of 256. A
block keeps each of its levels as one string of hex digests, 64 characters a
node: fixed-width substrings of two nodes are hashed to the next level, the
substring beside a node is its sibling. A block's last level is one node; the
blocks' nodes are the leaves of the next tier, until every group is one block,
and the groups' roots form a tree of the same kind.

A block is a group of at most 256 rows however large the table is. Only
digests are shuffled, never the rows they stand for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpulse.operators.keyed import number_rows
from outpulse.session import store

LEVELS = 8
BLOCK = 1 << LEVELS
HEX = 64


def encoded(column: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, ``:`` and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*columns: Column) -> Column:
    """Lowercase hex SHA-256 of the columns' texts, joined."""
    return F.sha2(F.concat(*columns), 256)


def _parents(level: Column) -> Column:
    """The next level: digests of two nodes each, of one at an odd end."""
    pairs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / (2 * HEX)).cast("int"))
    hashed = F.transform(pairs, lambda i: F.sha2(F.substring(level, i * (2 * HEX) + 1, F.lit(2 * HEX)), 256))
    return F.array_join(hashed, "").cast("binary")


def _blocks(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """(g, block, members, levels) from (g, pos, node, payload).

    A block that is not full is its group's only one if it is the first: its
    levels end at one node. All others have eight steps, an odd end is hashed
    alone. Level texts are held as bytes, whose substrings need no counting.
    """
    member = F.struct("pos", "node", *payload)
    grouped = nodes.groupBy("g", F.shiftright("pos", LEVELS).alias("block")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    count = F.size("members")
    alone = (F.col("block") == 0) & (count < BLOCK)
    needed = F.length(F.bin(count - 1)) - F.when(count == 1, 1).otherwise(0)
    steps = F.when(alone, needed).otherwise(F.lit(LEVELS)).cast("int")
    steps = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    first = F.array(F.array_join(F.col("members.node"), "").cast("binary"))
    levels = F.aggregate(steps, first, lambda done, _: F.concat(done, F.array(_parents(F.element_at(done, -1)))))
    return store(grouped.select("g", "block", "members", levels.alias("levels")), "merkle-blocks")


def _tiers(nodes: DataFrame, tiers: int, payload: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every tier, lowest first, and (g, pos, node) of the groups' roots."""
    stack: list[DataFrame] = []
    for tier in range(tiers):
        stack.append(_blocks(nodes, payload if tier == 0 else ()))
        nodes = stack[-1].select("g", F.col("block").alias("pos"), F.element_at("levels", -1).cast("string").alias("node"))
    return stack, nodes


def _siblings(levels: Column, place: Column) -> Column:
    """For every step of a node's way up its block, what stands beside it: (left, right), empty if nothing does."""

    def beside(level: Column, step: Column) -> Column:
        at = F.call_function("shiftright", place, step)
        other = F.substring(level, at.bitwiseXOR(F.lit(1)) * HEX + 1, F.lit(HEX)).cast("string")
        odd = at.bitwiseAND(F.lit(1)) == 1
        return F.struct(F.when(odd, other).otherwise("").alias("left"), F.when(odd, "").otherwise(other).alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), beside)


def _paths(stack: Sequence[DataFrame], above: DataFrame, payload: Sequence[str]) -> DataFrame:
    """(g, pos, node, payload, path, carried columns) of the lowest tier's nodes.

    ``above`` has (g, pos, path) of the groups' roots and columns to carry
    down. A block is joined with the one path that its root has; only then
    are its nodes told apart.
    """
    carried = [c for c in above.columns if c not in ("g", "pos", "path")]
    for tier in range(len(stack) - 1, -1, -1):
        ways = above.select("g", F.col("pos").alias("block"), F.col("path").alias("upper"), *carried)
        members = _with_paths(["pos", "node", *(payload if tier == 0 else ())])
        above = stack[tier].join(ways, ["g", "block"]).select("g", *carried, F.inline(members))
    return above


def _with_paths(kept: Sequence[str]) -> Column:
    """A block's members with their paths: inside the block, then that of its root."""

    def member(row: Column, place: Column) -> Column:
        path = F.concat(_siblings(F.col("levels"), place), F.col("upper"))
        return F.struct(*[row[c].alias(c) for c in kept], path.alias("path"))

    return F.transform("members", member)


def _tier_count(nodes: DataFrame) -> int:
    """Tiers until the largest group is one block; one number comes to the driver."""
    most = nodes.groupBy("g").count().agg(F.max("count")).first()[0] or 1
    return max(1, -(-(most - 1).bit_length() // LEVELS))


def _numbered(nodes: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """``pos`` from 0 inside every group; always by ranges, so that no group has to fit a task."""
    return number_rows(nodes, by, order, "_n", hot_rows=0, largest=1).withColumn("pos", F.col("_n") - 1).drop("_n")


def fold(start: Column, path: Column) -> Column:
    """The root that a node and what stands beside its way up give."""
    return F.aggregate(path, start, lambda node, beside: digest(beside["left"], node, beside["right"]))


def proof_digest(path: Column) -> Column:
    """SHA-256 of a path's siblings, from the lowest up."""
    return F.sha2(F.array_join(F.transform(path, lambda beside: F.concat(beside["left"], beside["right"])), ""), 256)


def manifest(leaves: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Every leaf with its way to the root, from (g, id, leaf, payload).

    Groups are told apart by ``g`` (null is a group of its own and comes
    first); inside a group leaves ascend by ``id``, nulls first, then by leaf.
    Every two consecutive nodes become the digest of both, a last single one
    its own digest, until one is left, the ``subroot``; the subroots in order
    of ``g`` give the ``root`` in the same way. Returns (g, id, leaf, payload,
    subroot, root, path); ``path`` lists (left, right) digests for each step,
    both empty where a node stands alone. Equal rows are leaves of their own.
    No rows give no rows. Names in ``payload`` must differ from the others.
    """
    named = F.when(F.col("g").isNull(), "").otherwise(F.concat(F.lit("."), F.col("g")))
    rows = store(
        leaves.select(named.alias("g"), F.col("leaf").alias("node"), F.col("id").alias("_id"), *payload,
                      F.monotonically_increasing_id().alias("_tie")), "merkle-leaves",
    )
    ordered = _numbered(rows, ["g"], [F.col("_id").asc_nulls_first(), F.col("node"), F.col("_tie")]).drop("_tie")
    stack, subroots = _tiers(ordered, _tier_count(rows), ["_id", *payload])

    groups = subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), "node")
    upper, root = _tiers(_numbered(groups, [], [F.col("of")]), _tier_count(groups), ["of"])
    none = F.array().cast("array<struct<left:string,right:string>>")
    above = _paths(upper, root.select("g", "pos", none.alias("path"), F.col("node").alias("root")), ["of"])
    above = above.select(F.col("of").alias("g"), F.lit(0).cast("long").alias("pos"), "path", F.col("node").alias("subroot"), "root")
    found = _paths(stack, above, ["_id", *payload])
    group = F.when(F.col("g") != "", F.expr("substring(g, 2)"))
    return found.select(group.alias("g"), F.col("_id").alias("id"), F.col("node").alias("leaf"), *payload, "subroot", "root", "path")


def document_leaf(n_chars: Column | None = None) -> Column:
    """A document's leaf, of its doc_id, source, lang, n_chars and text."""
    n_chars = F.col("n_chars") if n_chars is None else n_chars
    return digest(*[encoded(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))])


def verify(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Manifest of ``docs`` (doc_id, source, lang, n_chars, text) and a check of every row against it.

    Rows where ``tampered`` holds are checked with one added to ``n_chars``
    (null stays null and so passes), all others as they are: the recomputed
    leaf is folded with the original siblings, and the row is ``verified`` if
    that gives the root. By default rows are tampered with whose CRC-32 of
    the decimal doc_id divides by 7; a null doc_id is never tampered with.
    Null fields have an encoding of their own, null and empty differ; other
    columns do not enter. Repeated rows each have a leaf; an empty table gives
    no rows.
    """
    if tampered is None:
        tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = F.when(F.coalesce(tampered, F.lit(False)) & F.col("n_chars").isNotNull(), document_leaf(F.col("n_chars") + 1))
    leaves = docs.select(F.col("lang").alias("g"), F.col("doc_id").alias("id"), document_leaf().alias("leaf"), changed.alias("changed"))
    found = manifest(leaves, ["changed"])
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    found = found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


#: CRC-32 of a short text {0} for DuckDB, bit by bit.
CRC_SQL = """xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, length({0}) + 1),
  lambda i: [ord({0}[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"""

_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"

MANIFEST_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_LEAF.format(n="n_chars")} AS leaf,
    CASE WHEN {CRC_SQL.format("(doc_id::VARCHAR)")} % 7 = 0 AND n_chars IS NOT NULL THEN {_LEAF.format(n="(n_chars + 1)")} END AS changed
  FROM documents
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n FROM leaves
), low AS (
  SELECT lang, pos, leaf AS h, 0 AS step, n FROM ordered
  UNION ALL
  SELECT lang, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), max(step) + 1, (max(n) + 1) // 2
  FROM low WHERE n > 1 GROUP BY lang, pos // 2
), subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1
), high AS (
  SELECT pos, h, 0 AS step, n FROM subroots
  UNION ALL
  SELECT pos // 2, sha256(string_agg(h, '' ORDER BY pos)), max(step) + 1, (max(n) + 1) // 2
  FROM high WHERE n > 1 GROUP BY pos // 2
), beside AS (
  SELECT o.lang, o.pos, a.step, (o.pos >> a.step) & 1 AS odd, b.h
  FROM ordered o JOIN low a ON a.lang IS NOT DISTINCT FROM o.lang AND a.pos = o.pos >> a.step AND a.n > 1
  LEFT JOIN low b ON b.lang IS NOT DISTINCT FROM o.lang AND b.step = a.step AND b.pos = xor(a.pos, 1)
  UNION ALL
  SELECT o.lang, o.pos, 1000 + a.step, (s.pos >> a.step) & 1, b.h
  FROM ordered o JOIN subroots s ON s.lang IS NOT DISTINCT FROM o.lang JOIN high a ON a.pos = s.pos >> a.step AND a.n > 1
  LEFT JOIN high b ON b.step = a.step AND b.pos = xor(a.pos, 1)
), paths AS (
  SELECT lang, pos, list(CASE WHEN h IS NULL THEN '-' WHEN odd = 1 THEN 'L' || h ELSE 'R' || h END ORDER BY step) AS path,
    coalesce(string_agg(h, '' ORDER BY step), '') AS siblings
  FROM beside GROUP BY lang, pos
), folded AS (
  SELECT o.doc_id, o.leaf, s.h AS subroot, (SELECT h FROM high WHERE n = 1) AS root,
    sha256(coalesce(siblings, '')) AS proof_sha256,
    list_reduce([coalesce(changed, leaf)] || coalesce(path, CAST([] AS VARCHAR[])), lambda a, x: CASE x[1]
      WHEN 'L' THEN sha256(x[2:] || a) WHEN 'R' THEN sha256(a || x[2:]) ELSE sha256(a) END) AS folded_root
  FROM ordered o JOIN subroots s ON s.lang IS NOT DISTINCT FROM o.lang
  LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM o.lang AND p.pos = o.pos
)
SELECT *, folded_root = root AS verified FROM folded
"""
