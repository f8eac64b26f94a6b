"""Sharding by fixed virtual slots.

Records are hashed into 4,096 slots, whose number never changes. Bytes are
summed per slot, and a stored map says which shard a slot belongs to. Shards
are evened out, added or taken away by editing the map: an edit is a new
version that lists only the slots that move. A slot with more than its part
of the bytes is cut into pieces, dealt by the records' places in the slot, and
its map entry lists one shard for each piece.

What is gathered or broadcast are slots and pieces, at most 4,096 and 16 a
shard, however many records there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outpulse.operators.keyed import number_rows
from outpulse.session import run_dir, store

SLOTS = 4096
PIECES = 16
SLACK_PERCENT = 1
OVERHEAD = 16


def records(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, vslot, tie) of every row, stored; equal rows have equal slots and other ties."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
    )
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "text_crc32")
    slot = (F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % SLOTS).cast("int")
    return store(rows.withColumn("vslot", slot), "shard-records")


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``n``, a record's place in its slot from 0; slots may span partitions."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32"), F.col("tie")]
    placed = number_rows(rows, ["vslot"], order, "_n", hot_rows=0, largest=1)
    return placed.withColumn("n", F.col("_n") - 1).drop("_n", "tie")


def slot_pieces(rows: DataFrame, placed: DataFrame, shards: int) -> DataFrame:
    """(vslot, splits, piece, bytes, rows) of all slots, empty ones too, stored.

    A slot has one piece for each sixteenth of a shard's bytes that it holds,
    but no more pieces than records. Record ``n`` is in piece ``n % splits``.
    """
    spark = rows.sparkSession
    sums = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    part = F.greatest(F.floor(F.sum("bytes").over(Window.partitionBy()) / (PIECES * shards)), F.lit(1))
    wanted = F.least(F.ceil(F.col("bytes") / part), "rows")
    sums = sums.select("vslot", F.greatest(wanted, F.lit(1)).cast("int").alias("splits"))
    every = spark.range(SLOTS).select(F.col("id").cast("int").alias("vslot"))
    splits = every.join(F.broadcast(sums), "vslot", "left").select("vslot", F.coalesce("splits", F.lit(1)).alias("splits"))
    splits = store(splits, "shard-splits")
    dealt = placed.join(F.broadcast(splits), "vslot").groupBy("vslot", (F.col("n") % F.col("splits")).cast("int").alias("piece"))
    filled = dealt.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    pieces = splits.select("vslot", "splits", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("piece"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("bytes", "rows")]
    return store(pieces.join(F.broadcast(filled), ["vslot", "piece"], "left").select("vslot", "splits", "piece", *zero), "shard-pieces")


def _deal(pieces: Column, total: Column, shards: int, slack_percent: int) -> Column:
    """Shards for (weight, vslot, piece, old), heaviest first.

    A piece stays in its old shard while that holds at most its part of the
    bytes and the slack; else it goes to the lightest shard, the first of equal ones.
    """
    limit = F.floor(total / (100 * shards)) * (100 + slack_percent)

    def put(state: Column, piece: Column) -> Column:
        loads = state["loads"]
        old = piece["old"]
        stays = old.isNotNull() & (old < shards) & (F.get(loads, old) + piece["weight"] <= limit)
        lightest = F.array_position(loads, F.array_min(loads)).cast("int") - 1

        def with_shard(shard: Column) -> Column:
            after = F.transform(loads, lambda load, i: F.when(i == shard, load + piece["weight"]).otherwise(load))
            return F.struct(after.alias("loads"), F.array_append(state["picks"], shard).alias("picks"))

        return F.transform(F.array(F.when(stays, old).otherwise(lightest)), with_shard)[0]

    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"), F.array().cast("array<int>").alias("picks"))
    return F.aggregate(pieces, start, put, lambda state: state["picks"])


def rebalanced(pieces: DataFrame, current: DataFrame | None, shards: int, slack_percent: int = SLACK_PERCENT) -> DataFrame:
    """Map entries (vslot, shards) that ``current`` lacks or has otherwise; all of them if there is no map yet.

    Only pieces of shards above their part of the bytes, or of shards that are
    gone, move. One row of at most 4,096 and 16 a shard pieces is worked through.
    """
    old = F.lit(None).cast("int")
    if current is not None:
        pieces = pieces.join(F.broadcast(current.withColumnRenamed("shards", "_old")), "vslot", "left")
        old = F.get("_old", F.col("piece"))
    # One byte is added, so that empty pieces spread as well.
    listed = F.collect_list(F.struct((-F.col("bytes") - 1).alias("neg"), "vslot", "piece", old.alias("old")))
    ordered = pieces.agg(F.array_sort(listed).alias("p"), F.sum(F.col("bytes") + 1).alias("total"))
    weighed = F.transform("p", lambda x: F.struct((-x["neg"]).alias("weight"), x["vslot"].alias("vslot"), x["piece"].alias("piece"), x["old"].alias("old")))
    ordered = ordered.select(weighed.alias("p"), "total")
    dealt = ordered.select(F.inline(F.arrays_zip("p", _deal(F.col("p"), F.col("total"), shards, slack_percent).alias("shard"))))
    entries = dealt.groupBy("p.vslot").agg(F.array_sort(F.collect_list(F.struct("p.piece", "shard"))).alias("e"))
    entries = entries.select("vslot", F.col("e.shard").alias("shards"))
    if current is None:
        return entries
    kept = current.select(F.col("vslot").alias("_slot"), F.col("shards").alias("_shards"))
    return entries.join(F.broadcast(kept), (F.col("vslot") == F.col("_slot")) & (F.col("shards") == F.col("_shards")), "left_anti")


def write_version(entries: DataFrame, path: str, version: int) -> None:
    """Files the edits of a version beside those before; a version is never changed."""
    entries.coalesce(1).write.parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The map as of a version: the last entry of every slot."""
    edits = spark.read.schema("vslot INT, shards ARRAY<INT>, version INT").parquet(path).where(F.col("version") <= version)
    return edits.groupBy("vslot").agg(F.max_by("shards", "version").alias("shards"))


def assign(placed: DataFrame, pieces: DataFrame, current: DataFrame, later: DataFrame | None = None) -> DataFrame:
    """Rows with ``shard``, their place ``slot`` in it, gapless from 0, and the shard ``next_shard`` of the later map.

    Pieces stand in a shard by slot and piece number; a record's place is
    that of its piece's first record and its own number in the piece. No row
    is sorted for it.
    """
    spread = pieces.join(F.broadcast(current), "vslot").withColumn("shard", F.get("shards", F.col("piece"))).drop("shards")
    held = spread.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("vslot", "piece", "splits", "rows"))).alias("p"))
    before = F.transform("p", lambda x, i: F.struct(x["vslot"].alias("vslot"), x["piece"].alias("piece"), F.aggregate(
        F.slice("p", F.lit(1), i), F.lit(0).cast("long"), lambda a, y: a + y["rows"]).alias("start")))
    starts = held.select("shard", F.inline(before))
    if later is not None:
        starts = starts.join(F.broadcast(later.withColumnRenamed("shards", "_later")), "vslot")
    moved = F.get("_later", F.col("piece")) if later is not None else F.lit(None).cast("int")
    starts = starts.select("vslot", F.struct("piece", "shard", "start", moved.alias("next")).alias("e"))
    lists = starts.groupBy("vslot").agg(F.array_sort(F.collect_list("e")).alias("_e"))
    splits = F.size("_e")
    entry = F.get("_e", (F.col("n") % splits).cast("int"))
    rows = placed.join(F.broadcast(lists), "vslot")
    return rows.select(
        *placed.columns, entry["shard"].alias("shard"), (entry["start"] + F.floor(F.col("n") / splits)).alias("slot"),
        entry["next"].alias("next_shard"),
    )


def shard(docs: DataFrame, shards: int = 40, path: str | None = None) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) in one of ``shards`` shards of near equal bytes.

    Columns: doc_id, size (UTF-8 bytes of the text and 16), text_crc32, law
    (``bytes``), shard, slot (place in the shard, from 0), grown_shard (null:
    that law is not ours), vslot, and next_shard, the shard under version 2 of
    the map, which makes room for one more. The map is kept below ``path``,
    by default in the shared folder.

    A null text counts as empty. Null doc_ids, ties and repeated rows are
    records like others: equal rows share a slot, which is cut into pieces if
    they are many. A shard can exceed its part by no more than one piece or
    one record. Other columns are not read; no rows give no rows.
    """
    spark = docs.sparkSession
    path = path or run_dir(spark, "shard-map")
    rows = records(docs)
    placed = numbered(rows)
    pieces = slot_pieces(rows, placed, shards)
    write_version(rebalanced(pieces, None, shards), path, 1)
    first = read_map(spark, path, 1)
    write_version(rebalanced(pieces, first, shards + 1, slack_percent=0), path, 2)
    found = assign(placed, pieces, first, read_map(spark, path, 2))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", "next_shard",
    )


def _crc_table() -> list[int]:
    """CRC-32 of each byte value: its eight bits, one by one, against the reversed polynomial."""
    table = list(range(256))
    for _ in range(8):
        table = [(x >> 1) ^ (0xEDB88320 * (x & 1)) for x in table]
    return table


_LIMIT = "((SELECT sum(bytes + 1) FROM pieces) // (100 * {k})) * 100"

_DEALT = """{name} AS (
  SELECT 0::BIGINT AS nth, list_transform(range({k}), lambda x: 0::BIGINT) AS loads, NULL::INT AS vslot, NULL::INT AS piece, NULL::INT AS shard
  UNION ALL
  SELECT nth + 1, list_transform(loads, lambda x, i: CASE WHEN i - 1 = put THEN x + weight ELSE x END), q.vslot, q.piece, put
  FROM (SELECT d.nth, d.loads, r.vslot, r.piece, r.weight,
          CASE WHEN o.shard IS NOT NULL AND d.loads[o.shard + 1] + r.weight <= {limit} THEN o.shard
               ELSE list_position(d.loads, list_min(d.loads)) - 1 END::INT AS put
        FROM {name} d JOIN ranked r ON r.place = d.nth + 1 LEFT JOIN {old} o ON o.vslot = r.vslot AND o.piece = r.piece) q
)"""

#: The same shards for DuckDB.
SHARDS_SQL = (
    """
WITH RECURSIVE sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
    xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda b: ('0x' || b)::BIGINT), lambda a, b: xor(("""
    + str(_crc_table())
    + """::BIGINT[])[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) AS text_crc32
  FROM documents
), slotted AS (
  SELECT *, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || size || ':' || text_crc32), 1, 8))::BIGINT % 4096)::INT AS vslot
  FROM sized
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY vslot ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS n FROM slotted
), sums AS (
  SELECT vslot, least(ceil(sum(size) / greatest((SELECT sum(size) FROM placed) // 640, 1)), count(*))::INT AS splits FROM placed GROUP BY vslot
), filled AS (
  SELECT vslot, (n % splits)::INT AS piece, sum(size) AS bytes, count(*) AS rows FROM placed JOIN sums USING (vslot) GROUP BY ALL
), slots AS (
  SELECT range::INT AS vslot, coalesce(splits, 1)::INT AS splits FROM range(4096) LEFT JOIN sums ON vslot = range
), pieces AS (
  SELECT vslot, splits, piece, coalesce(bytes, 0)::BIGINT AS bytes, coalesce(rows, 0) AS rows
  FROM (SELECT vslot, splits, unnest(range(splits))::INT AS piece FROM slots) LEFT JOIN filled USING (vslot, piece)
), ranked AS (
  SELECT *, bytes + 1 AS weight, row_number() OVER (ORDER BY bytes DESC, vslot, piece) AS place FROM pieces
), nothing AS (
  SELECT NULL::INT AS vslot, NULL::INT AS piece, NULL::INT AS shard WHERE false
), """
    + _DEALT.format(name="one", k=40, old="nothing", limit=_LIMIT.format(k=40))
    + ", "
    + _DEALT.format(name="two", k=41, old="one", limit=_LIMIT.format(k=41))
    + """, starts AS (
  SELECT p.vslot, p.piece, p.splits, one.shard, two.shard AS next_shard,
    sum(p.rows) OVER (PARTITION BY one.shard ORDER BY p.vslot, p.piece) - p.rows AS start
  FROM pieces p JOIN one ON one.vslot = p.vslot AND one.piece = p.piece JOIN two ON two.vslot = p.vslot AND two.piece = p.piece
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, (start + n // splits)::BIGINT AS slot, NULL::INT AS grown_shard, d.vslot, next_shard
FROM placed d JOIN starts s ON s.vslot = d.vslot AND s.piece = d.n % s.splits
"""
)
