"""Keyed building blocks: first per key, idempotent append, numbering, bounded joins.

None of them gathers an unbounded group: limits per key run map-side first,
numbering splits hot groups by range, joins beyond a checked size are salted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.session import cut_lineage

HOT_ROWS = 1_000_000
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 * 1024 * 1024
SALTS = 32


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def top_n_per(df: DataFrame, by: Sequence[str | Column], order_by: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows of every group.

    Spark cuts each group to ``n`` rows per map task before the shuffle, so a
    hot group costs no more than a small one.
    """
    place = F.row_number().over(Window.partitionBy(*_columns(by)).orderBy(*_columns(order_by)))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in the given order; NULL keys form a key of their own."""
    return top_n_per(df, keys, order_by, 1)


def append_new(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ("_seq",)
) -> DataFrame:
    """Incoming rows whose key the archive does not hold; the first row per key wins.

    Keys compare null-safely, so a NULL key is appended once.
    """
    fresh = first_per_key(incoming, keys, order_by)
    known = existing.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys])
    return fresh.join(known, same, "left_anti")


def new_keys(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``incoming`` that ``existing`` lacks, each once."""
    return append_new(existing, incoming.select(*keys).distinct(), keys, order_by=list(keys))


def unseen(df: DataFrame, seen: DataFrame, order_by: Sequence[str | Column], by: Sequence[str] = ()) -> DataFrame:
    """First row per URL, without the URLs of the seen store."""
    keys = [*by, "url"]
    return first_per_key(df, keys, order_by).join(seen.select(*keys), keys, "left_anti")


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[Column],
    name: str,
    hot_rows: int = HOT_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Dense 1-based row numbers per group, whatever the group's size.

    Groups up to ``hot_rows`` are numbered by one window. If any group is
    larger, rows are range-partitioned on group and order, so that a hot group
    spans many partitions; a row's number is then its place in its partition
    plus the rows of its group in earlier partitions. The partitions are fixed
    by a reliable checkpoint before anything is counted. A caller that knows
    the ``largest`` group saves the counting.
    """
    by = list(by)
    if largest is None:
        largest = df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    if largest <= hot_rows:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order_by))
        return df.withColumn(name, place.cast("bigint"))

    ordered = [F.col(c).asc() for c in by] + list(order_by)
    placed = cut_lineage(df.repartitionByRange(*ordered).sortWithinPartitions(*ordered))
    address = F.monotonically_increasing_id()
    placed = placed.withColumn("_address", address).select(
        *df.columns,
        F.shiftright("_address", 33).alias("_part"),
        F.col("_address").bitwiseAND(F.lit(2**33 - 1)).alias("_at"),
    )
    runs = placed.groupBy("_part", *by).agg(F.min("_at").alias("_from"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("_part").alias("_run_part"),
        *[F.col(c).alias(f"_run_{c}") for c in by],
        "_from",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"_run_{c}")) for c in by],
        F.col("_part") == F.col("_run_part"),
    )
    return placed.join(runs, same).select(
        *df.columns, (F.col("_at") - F.col("_from") + F.col("_before") + 1).alias(name)
    )


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measured check of a table's size; looks at no more than ``rows + 1`` rows."""
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    n, total = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= rows and total <= size


def join_lookup(
    df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner", salts: int = SALTS,
    rows: int | None = None,
) -> DataFrame:
    """Join a large, possibly skewed table with a lookup table on its columns.

    The lookup side is broadcast only if it passes :func:`fits_broadcast`, or
    if the caller made it from a list of ``rows`` entries and that is few.
    Beyond that, its rows are copied to ``salts`` salts, and a hot key of the
    large side spreads over as many tasks.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    on = list(on)
    if rows <= BROADCAST_ROWS if rows is not None else fits_broadcast(table):
        return df.join(F.broadcast(table), on, how)
    return salted_join(df, table, on, how, salts)


def salted_join(df: DataFrame, table: DataFrame, on: list[str], how: str, salts: int = SALTS) -> DataFrame:
    """Join that spreads every key of ``df`` over ``salts`` tasks; each salt finds all rows of ``table``."""
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *df.columns), F.lit(salts).cast("bigint"))
    salts_of = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    copies = table.withColumn("_salt", F.explode(salts_of))
    return df.withColumn("_salt", salt).join(copies, [*on, "_salt"], how).drop("_salt")
