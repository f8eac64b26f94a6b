from datetime import date

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from outpulse.operators import keyed as K

D1, D2 = date(2026, 4, 1), date(2026, 4, 2)


def test_append_new_keeps_what_is_there(spark):
    existing = spark.createDataFrame([(D1, 5)], "date DATE, views INT")
    incoming = spark.createDataFrame([(D1, 9, 1), (D2, 3, 2), (D2, 4, 3)], "date DATE, views INT, _seq INT")
    added = K.append_new(existing, incoming, ["date"])
    assert [(r.date, r.views) for r in added.collect()] == [(D2, 3)]
    after = existing.unionByName(added.select("date", "views"))
    assert K.append_new(after, incoming, ["date"]).count() == 0


def test_append_new_two_columns_and_null_keys(spark):
    existing = spark.createDataFrame([(D1, "a")], "date DATE, k STRING")
    incoming = spark.createDataFrame([(D1, "b", 1), (D2, "a", 1), (D2, None, 1), (D2, None, 2)], "date DATE, k STRING, _seq INT")
    added = K.append_new(existing, incoming, ["date", "k"])
    assert sorted((r.date, r.k or "") for r in added.collect()) == [(D1, "b"), (D2, ""), (D2, "a")]
    after = existing.unionByName(added.drop("_seq"))
    assert K.append_new(after, incoming, ["date", "k"]).count() == 0


def test_first_per_key_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    picked = K.first_per_key(df, ["k"], [F.desc("id")])
    assert plan_of(picked).count("WindowGroupLimit") == 2
    assert sorted(r.id for r in picked.collect()) == list(range(993, 1000))


def test_top_n_is_a_prefix_and_ignores_partitioning(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), (F.col("id") * 37 % 101).alias("v"), "id")
    top = {n: {tuple(r) for r in K.top_n_per(df, ["k"], ["v", "id"], n).collect()} for n in (4, 5)}
    assert top[4] < top[5]
    assert top[5] == {tuple(r) for r in K.top_n_per(df.repartition(11, "v"), ["k"], ["v", "id"], 5).collect()}


@pytest.mark.parametrize("by", [["k"], []])
def test_number_rows_splits_hot_groups(spark, by):
    # One key holds most rows, one is NULL, and the order has long ties before its last column.
    key = F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 9 == 2, F.lit(None)).otherwise((F.col("id") % 11).cast("string"))
    df = spark.range(5000).select(key.alias("k"), (F.col("id") % 4).alias("v"), "id")
    order = [F.desc("v"), F.col("id").asc()]
    plain = K.number_rows(df, by, order, "n")
    split = K.number_rows(df, by, order, "n", hot_rows=100)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_unseen_takes_the_first_row_per_url(spark):
    df = spark.createDataFrame([("u1", 2), ("u1", 1), ("u2", 3), ("u3", 4)], "url STRING, pos INT")
    seen = spark.createDataFrame([("u2",), ("u2",)], "url STRING")
    assert sorted(tuple(r) for r in K.unseen(df, seen, ["pos"]).collect()) == [("u1", 1), ("u3", 4)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, how):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 17).alias("k"), "id")
    table = spark.range(0, 10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = df.join(table, ["k"], how)
    assert sorted(K.salted_join(df, table, ["k"], how, 8).collect()) == sorted(plain.collect())
    assert sorted(K.join_lookup(df, table, ["k"], how).collect()) == sorted(plain.collect())


def test_broadcast_check_measures_rows_and_bytes(spark):
    df = spark.range(100).withColumn("t", F.repeat(F.lit("x"), 100))
    assert K.fits_broadcast(df)
    assert not K.fits_broadcast(df, rows=99)
    assert not K.fits_broadcast(df, size=5000)
