import zlib
from collections import Counter, defaultdict

import pytest
from odd_rows import SF, nothing, odd  # noqa: F401
from pyspark.sql import functions as F

from outpulse.llm import shards
from outpulse.session import run_dir

COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "vslot", "next_shard"]


def check(rows, found, count=40):
    """Every record once, places without gaps, and shards that differ by no more than a piece or a record."""
    want = Counter((d, 16 + len((t or "").encode()), zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    places, loads, grown = defaultdict(list), Counter(), Counter()
    for r in found:
        assert (r.law, r.grown_shard) == ("bytes", None) and 0 <= r.shard < count and 0 <= r.next_shard <= count
        places[r.shard].append(r.slot)
        loads[r.shard] += r.size
        grown[r.next_shard] += r.size
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    total = sum(loads.values())
    pieces = Counter()
    for r in found:
        pieces[r.vslot] += r.size
    most = max([min(x, total // (16 * count) * 2 + max(r.size for r in found)) for x in pieces.values()], default=0)
    for sums, n in ((loads, count), (grown, count + 1)):
        assert max(sums.values(), default=0) <= total / n + most + n


def test_odd_rows(odd):
    docs = odd[0].withColumns({"shard": F.lit("clash"), "slot": F.lit(1), "vslot": F.lit(2), "tie": F.lit(3), "n": F.lit(4)})
    found = shards.shard(docs)
    assert found.columns == COLUMNS
    check([(r[0], r[1]) for r in odd[1]], found.collect())


def test_empty(nothing):
    found = shards.shard(nothing)
    assert found.columns == COLUMNS and found.collect() == []


def test_a_third_of_all_rows_equal(spark):
    """Equal rows share a slot; its pieces spread over the shards."""
    rows = [(None, "the same text")] * 4000 + [(i, "x" * (i % 90)) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(7)
    found = shards.shard(docs).collect()
    check(rows, found)
    sums = Counter()
    for r in found:
        sums[r.shard] += r.size
    assert max(sums.values()) <= 1.02 * min(sums.values())
    assert len({r.shard for r in found if r.doc_id is None}) > 10


def test_rerun_and_layout_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, two = (sorted(map(tuple, shards.shard(d).collect())) for d in (docs, docs.repartition(13)))
    assert one == two


@pytest.fixture
def sizes(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 400).cast("int")).alias("text"))
    rows = shards.records(docs)
    return rows, shards.numbered(rows)


def loads_of(pieces, current):
    spread = pieces.join(current, "vslot").select(F.get("shards", F.col("piece")).alias("s"), "bytes")
    return {r.s: r["sum(bytes)"] for r in spread.groupBy("s").sum("bytes").collect()}


def test_edits_move_little(spark, sizes):
    """A version holds only what moves; a new shard is filled from all others; a lost one is dealt out."""
    rows, placed = sizes
    pieces, path = shards.slot_pieces(rows, placed, 10), run_dir(spark, "test-map")
    shards.write_version(shards.rebalanced(pieces, None, 10), path, 1)
    first = shards.read_map(spark, path, 1)
    assert first.count() == shards.SLOTS
    assert shards.rebalanced(pieces, first, 10).count() == 0
    shards.write_version(shards.rebalanced(pieces, first, 11), path, 2)
    second = shards.read_map(spark, path, 2)
    moved = spark.read.parquet(path).where("version = 2")
    assert 0 < moved.count() < 0.2 * shards.SLOTS
    assert {x for r in moved.collect() for x in r.shards} == {10}
    shards.write_version(shards.rebalanced(pieces, second, 9), path, 3)
    third = loads_of(pieces, shards.read_map(spark, path, 3))
    assert set(third) == set(range(9)) and max(third.values()) <= 1.02 * min(third.values())
    assert loads_of(pieces, shards.read_map(spark, path, 1)) == loads_of(pieces, first)


def test_native(spark):
    found = shards.shard(spark.read.parquet(f"{SF}/documents.parquet"))
    assert "Python" not in found._jdf.queryExecution().toString()
