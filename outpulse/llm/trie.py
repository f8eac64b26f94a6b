"""Prefix trie of conversations, built as a distributed z-fast trie.

A turn is a symbol, a prefix is told by a 128-bit chained hash. The trie is
compacted: its nodes are the root, the ends of conversations and the places
where they part; an edge holds the hashes of all depths between two nodes.
Nodes are filed under their handle, the prefix at the depth in (parent, node]
that divides by the largest power of two. A conversation finds the deepest
node on its way by a binary search whose every step is one lookup of such a
depth (the fat binary search), so a search of ``n`` turns takes log2(n) joins.

Conversations are inserted in batches that grow fourfold. A batch looks up its exit
nodes in the trie so far; edges that are left midway are cut, and what is
new below becomes nodes where the batch's conversations end or part. Equal
conversations enter once, with their number. Joins go from many rows to one
node, sums are made map-side first, so a first turn or a conversation that
a third of the table shares loads no single task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.llm.merkle import CRC_SQL
from outpulse.session import store

ROOT = bytes(16)
HEAD_TURNS = 6
CHUNK_IDS = 4096
#: A class of conversations joins the first batch whose bound exceeds its hash modulo the last bound.
BATCHES = (1, 4, 16)

_CHAINED = "conv_id BIGINT, key BINARY, keys ARRAY<BINARY>, cum ARRAY<BIGINT>"


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) with (pos, symbol, size) of every turn in order, stored; texts are not shuffled.

    Turns go by number, null first, then by their symbol, the MD5 of role and
    text; null roles and texts count as empty. Repeated rows are turns of
    their own. Rows without conv_id are left out.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    symbol = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", symbol.alias("symbol"), F.length(text).cast("long").alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "symbol")
    rows = rows.select("conv_id", F.struct(F.row_number().over(order).alias("pos"), "symbol", "size").alias("t"))
    return store(rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")), "trie-turns")


def with_shared_heads(lists: DataFrame, every: int = 100) -> DataFrame:
    """Conversations that begin with turns of another one.

    Conversation c starts with the first h turns of conversation c - c % 100,
    where h is the CRC-32 of c's decimal modulo 6, and goes on with its own
    turns after its first h. Absent ones give no turns.
    """
    own = lists.withColumns({
        "_h": (F.crc32(F.col("conv_id").cast("string")) % HEAD_TURNS).cast("int"), "_base": F.col("conv_id") - F.col("conv_id") % every,
    })
    heads = lists.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, HEAD_TURNS).alias("_head"))
    head = F.slice(F.coalesce("_head", F.filter("turns", lambda _: F.lit(False))), F.lit(1), F.col("_h"))
    tail = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    return own.join(heads, "_base", "left").select("conv_id", F.concat(head, tail).alias("turns"))


def _chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every conversation the hashes and summed sizes of its prefixes, the empty one first."""
    schema = pa.schema([("conv_id", pa.int64()), ("key", pa.binary()), ("keys", pa.list_(pa.binary())), ("cum", pa.list_(pa.int64()))])
    for batch in batches:
        rows = []
        for conv_id, symbols, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            keys, cum = [ROOT], [0]
            for symbol, size in zip(symbols, sizes, strict=True):
                keys.append(hashlib.blake2b(keys[-1] + symbol.encode(), digest_size=16).digest())
                cum.append(cum[-1] + size)
            rows.append((conv_id, keys[-1], keys, cum))
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 4, schema, strict=True)], schema=schema)


def prefixes(lists: DataFrame) -> DataFrame:
    """(conv_id, key, keys, cum): hash of the whole, hashes and summed text sizes of all prefixes, stored."""
    flat = lists.select("conv_id", F.col("turns.symbol").alias("s"), F.col("turns.size").alias("n"))
    return store(flat.mapInArrow(_chained, _CHAINED), "trie-prefixes")


def _fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that divides by the largest power of two."""
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1), F.length(F.bin(low.bitwiseXOR(high))) - 1))


def _filed(nodes: DataFrame) -> DataFrame:
    """Nodes (key, pkey, p, e, ekeys, ecum) with the handle they are found under and the first hash of their edge."""
    handle = F.get("ekeys", _fattest(F.col("p"), F.col("e")) - F.col("p") - 1)
    return nodes.select("key", "pkey", "p", "e", "ekeys", "ecum", handle.alias("handle"), F.get("ekeys", F.lit(0)).alias("first"))


def locate(batch: DataFrame, nodes: DataFrame, rounds: int) -> DataFrame:
    """Adds ``a``, the depth of the deepest node on a conversation's way, ``shared``, how far it
    goes along the edge below, and ``edge``, the key of the exit node, if it enters that edge.

    Each round asks for the prefix at the fattest depth between the deepest
    node found and the shallowest depth known to have none below. A handle
    whose node the conversation does not reach settles the search.
    """
    state = batch.withColumns({"len": F.size("keys") - 1, "a": F.lit(0), "b": F.size("keys") - 1})
    filed = nodes.select(F.col("handle").alias("_probe"), F.col("key").alias("_key"), F.col("p").alias("_p"), F.col("e").alias("_e"))
    for _ in range(rounds):
        fat = F.when(F.col("a") < F.col("b"), _fattest(F.col("a"), F.col("b")))
        # A finished search asks for its own key, so that none of them meet in one task.
        asked = state.withColumn("_f", fat).withColumn("_probe", F.coalesce(F.get("keys", F.col("_f")), "key"))
        joined = asked.join(filed, "_probe", "left")
        open_ = F.col("_f").isNotNull()
        found = open_ & F.col("_e").isNotNull()
        passed = found & (F.col("_e") <= F.col("len")) & (F.get("keys", F.col("_e")) == F.col("_key"))
        state = joined.select(
            *batch.columns, "len",
            F.when(passed, F.col("_e")).when(found, F.col("_p")).otherwise(F.col("a")).alias("a"),
            F.when(passed, F.col("b")).when(found, F.col("_p")).when(open_, F.col("_f") - 1).otherwise(F.col("b")).alias("b"),
        )
    edges = nodes.select(F.col("first").alias("_first"), F.col("key").alias("edge"), "ekeys")
    asked = state.withColumn("_first", F.coalesce(F.get("keys", F.col("a") + 1), "key"))
    joined = asked.join(edges, "_first", "left")
    enters = F.col("edge").isNotNull() & (F.col("a") < F.col("len"))
    most = F.least(F.size("ekeys"), F.col("len") - F.col("a"))
    along = F.filter(F.sequence(F.lit(1), most), lambda i: F.get("ekeys", i - 1) == F.get("keys", F.col("a") + i))
    shared = F.when(enters, F.col("a") + F.size(along)).otherwise(F.col("a"))
    return joined.select(*batch.columns, "len", "a", shared.alias("shared"), F.when(enters, F.col("edge")).alias("edge"))


def _cut(nodes: DataFrame, located: DataFrame) -> DataFrame:
    """Nodes, and new ones where conversations of the batch leave an edge midway."""
    cuts = located.where("edge IS NOT NULL").groupBy(F.col("edge").alias("key")).agg(F.collect_set("shared").alias("cuts"))
    bounds = F.concat(F.array("p"), F.array_sort(F.coalesce("cuts", F.array().cast("array<int>"))), F.array("e"))
    rows = nodes.join(cuts, "key", "left").select("pkey", "p", "ekeys", "ecum", bounds.alias("bounds"))
    rows = rows.select("*", F.posexplode(F.slice("bounds", F.lit(2), F.size("bounds") - 1)).alias("i", "high"))
    low, high = F.get("bounds", F.col("i")) - F.col("p"), F.col("high") - F.col("p")
    return rows.select(
        F.get("ekeys", high - 1).alias("key"), F.when(low == 0, F.col("pkey")).otherwise(F.get("ekeys", low - 1)).alias("pkey"),
        (low + F.col("p")).alias("p"), F.col("high").alias("e"), F.slice("ekeys", low + 1, high - low).alias("ekeys"),
        F.slice("ecum", low + 1, high - low + 1).alias("ecum"),
    )


def _grown(located: DataFrame) -> DataFrame:
    """Nodes below the trie so far: where the batch's conversations end or part after leaving it.

    One conversation stands for each such node and gives its edge.
    """
    beyond = located.where(F.col("shared") < F.col("len")).select(
        "key", "keys", F.explode(F.sequence(F.col("shared") + 1, F.col("len"))).alias("d")
    )
    steps = beyond.select("key", "d", F.get("keys", F.col("d")).alias("at"), F.get("keys", F.col("d") + 1).alias("next"))
    seen = steps.groupBy("at").agg(
        F.min("next").alias("low"), F.max("next").alias("high"), F.max(F.col("next").isNull()).alias("ends"), F.min("key").alias("stands")
    )
    parting = seen.where(F.col("ends") | (F.col("low") != F.col("high"))).select("at", "stands")
    marks = steps.join(parting, "at").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("d", (F.col("stands") == F.col("key")).alias("own")))).alias("marks"))
    rows = located.join(marks, "key").select("keys", "cum", "shared", "marks", F.posexplode("marks").alias("i", "mark")).where("mark.own")
    low = F.when(F.col("i") == 0, F.col("shared")).otherwise(F.get("marks", F.col("i") - 1)["d"])
    rows = rows.select("keys", "cum", low.alias("p"), F.col("mark.d").alias("e"))
    return rows.select(
        F.get("keys", F.col("e")).alias("key"), F.get("keys", F.col("p")).alias("pkey"), "p", "e",
        F.slice("keys", F.col("p") + 2, F.col("e") - F.col("p")).alias("ekeys"),
        F.slice("cum", F.col("p") + 1, F.col("e") - F.col("p") + 1).alias("ecum"),
    )


def insert(nodes: DataFrame, batch: DataFrame, rounds: int) -> DataFrame:
    """The trie's nodes after a batch of distinct (key, keys, cum), stored."""
    located = store(locate(batch, nodes, rounds), "trie-located")
    return store(_filed(_cut(nodes, located).union(_grown(located))), "trie-nodes")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """(key, n, text, least, leaves, edges): sums over all nodes below and the node itself.

    Rounds of doubling: a node knows the sums of those nearer than 2^k below
    it and its ancestor 2^k above, and passes the sums to that one. So the number of
    rounds is the logarithm of the trie's height.
    """
    added = ("n", "text", "leaves", "edges")
    state = store(nodes, "trie-sums")
    while not state.where("up IS NOT NULL").isEmpty():
        passed = state.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(
            *[F.sum(c).alias(f"_{c}") for c in added], F.min("least").alias("_least")
        )
        further = state.select(F.col("key").alias("_at"), F.col("up").alias("_up"))
        moved = state.withColumn("_at", F.coalesce("up", "key")).join(further, "_at")
        state = store(moved.join(passed, "key", "left").select(
            "key", F.when(F.col("up").isNotNull(), F.col("_up")).alias("up"),
            *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in added], F.least("least", "_least").alias("least"),
        ), "trie-sums")
    return state.drop("up")


def _id_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) to (key, first, ids), up to 4,096 ids each."""
    key, ids = None, []
    for batch in batches:
        out = []
        for k, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if ids and (k != key or len(ids) == CHUNK_IDS):
                out.append((key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = k
            ids.append(conv_id)
        yield _chunk_batch(out)
    if ids:
        yield _chunk_batch([(key, ids[0], ",".join(map(str, ids)))])


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.string()))], ["key", "first", "ids"])


def _id_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to (key, ends): one running SHA-256, whatever the number of ids."""

    def made(rows):
        return pa.record_batch([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["key", "ends"])

    key, running = None, None
    for batch in batches:
        out = []
        for k, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if running is not None and k == key:
                running.update(b"," + ids.encode())
                continue
            if running is not None:
                out.append((key, running.hexdigest()))
            key, running = k, hashlib.sha256(ids.encode())
        yield made(out)
    if running is not None:
        yield made([(key, running.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the ascending conv_ids of (key, conv_id), comma-joined.

    Ids are sorted by ranges of key and id and packed, so the one task that a
    hash over a large group needs reads packed ids and keeps none of them.
    """
    packed = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    packed = packed.mapInArrow(_id_chunks, "key BINARY, first BIGINT, ids STRING")
    return packed.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_id_digests, "key BINARY, ends STRING")


def build(chains: DataFrame) -> DataFrame:
    """Nodes of the compacted trie of :func:`prefixes`' rows, the root left out, stored."""
    spark = chains.sparkSession
    classes = store(chains.groupBy("key").agg(F.first("keys").alias("keys"), F.first("cum").alias("cum")), "trie-classes")
    longest = classes.agg(F.max(F.size("keys"))).first()[0] or 1
    rounds = (longest - 1).bit_length()
    none = spark.createDataFrame([], "key BINARY, pkey BINARY, p INT, e INT, ekeys ARRAY<BINARY>, ecum ARRAY<BIGINT>")
    nodes = _filed(none)
    place = F.pmod(F.xxhash64("key"), F.lit(BATCHES[-1]))
    for i, bound in enumerate(BATCHES):
        low = BATCHES[i - 1] if i else 0
        nodes = insert(nodes, classes.where((place >= low) & (place < bound)), rounds if i else 0)
    return nodes


def trie(lists: DataFrame) -> DataFrame:
    """Every node of the prefix trie of (conv_id, turns), turns as in :func:`turn_lists`.

    Columns: conv_id (smallest member), depth, parent_conv_id (null at the
    root), n_convs, n_children, n_leaves, saved_tokens (code points that are
    stored once instead of ``n_convs`` times, over the subtree), ends_sha256
    (members that end here). Conversations without turns end at the root;
    without conversations there is no root.
    """
    chains = prefixes(lists)
    nodes = build(chains)
    ended = chains.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.max(F.element_at("cum", -1)).alias("t"))
    root = chains.agg(F.count("*").alias("c")).where("c > 0").select(
        F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("pkey"), F.lit(-1).alias("p"), F.lit(0).alias("e"),
        F.array(F.lit(0).cast("long"), F.lit(0).cast("long")).alias("ecum"),
    )
    nodes = nodes.select("key", "pkey", "p", "e", "ecum").union(root)
    children = nodes.where("pkey IS NOT NULL").groupBy(F.col("pkey").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = store(nodes.join(children, "key", "left").join(ended, "key", "left").select(
        "key", "pkey", "p", "e", "ecum", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n", F.lit(0)).alias("n"), "least", "t"
    ), "trie-full")
    edge = F.element_at("ecum", -1) - F.get("ecum", F.lit(0))
    sums = _subtree_sums(nodes.select(
        "key", F.col("pkey").alias("up"), "n", (F.col("n") * F.coalesce("t", F.lit(0))).alias("text"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"), edge.alias("edges"), "least",
    ))
    above = sums.select(F.col("key").alias("pkey"), F.col("least").alias("above"))
    full = nodes.select("key", "pkey", "p", "e", "ecum", "n_children").join(sums, "key")
    full = full.withColumn("_up", F.coalesce("pkey", "key")).join(above.withColumnRenamed("pkey", "_up"), "_up")
    full = full.join(end_digests(chains.select("key", "conv_id")), "key", "left")
    each = full.select("*", F.explode(F.sequence(F.col("p") + 1, F.col("e"))).alias("d"))
    last, before = F.col("d") == F.col("e"), F.get("ecum", F.col("d") - 1 - F.col("p"))
    saved = F.col("text") - F.col("n") * before - (F.col("edges") - (before - F.get("ecum", F.lit(0))))
    parent = F.when(F.col("d") > F.col("p") + 1, F.col("least")).when(F.col("pkey").isNotNull(), F.col("above"))
    return each.select(
        F.col("least").alias("conv_id"), F.col("d").cast("long").alias("depth"), parent.alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"), F.coalesce(F.when(last, F.col("ends")), F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


#: The same nodes for DuckDB: a prefix is the joined symbols of its turns.
TRIE_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS size,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS symbol
  FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, symbol) AS pos FROM turns
), convs AS (
  SELECT conv_id, {CRC_SQL.format("(conv_id::VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM placed)
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, symbol, size FROM convs c JOIN placed t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, symbol, size FROM convs c JOIN placed t ON t.conv_id = c.conv_id AND t.pos > c.h
), prefixes AS (
  SELECT conv_id, string_agg(symbol, '') OVER (PARTITION BY conv_id ORDER BY part, pos) AS key, size,
    row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, count(*) OVER (PARTITION BY conv_id) AS turns
  FROM rebuilt
  UNION ALL
  SELECT conv_id, '', 0, 0, (SELECT count(*) FROM rebuilt r WHERE r.conv_id = c.conv_id) FROM convs c
), nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = turns), '')) AS ends_sha256
  FROM prefixes GROUP BY key, depth
), children AS (
  SELECT left(key, length(key) - 32) AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), full_nodes AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (key)
), subtrees AS (
  SELECT key, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens FROM (
    SELECT n_children, n_convs, size, unnest(list_transform(range(depth + 1), lambda d: left(f.key, 32 * d))) AS key FROM full_nodes f
  ) GROUP BY key
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN subtrees USING (key) LEFT JOIN nodes p ON n.depth > 0 AND p.key = left(n.key, length(n.key) - 32)
"""
