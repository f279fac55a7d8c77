"""Measured heavy keys."""

from pyspark.sql import functions as F

from forumshift.operators import joins


def test_only_heavy_keys_are_copied(spark, monkeypatch):
    monkeypatch.setattr(joins, "LEAST_ROWS", 50)
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    heavy = joins.heavy_keys(big, ["k"], lanes=30)
    assert [r[0] for r in heavy] == [7] and 10 <= heavy[0][1] <= 12          # a third of the rows, a third of the lanes
    small = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    plan = joins.spread_join(big, small, ["k"])
    want = sorted(map(tuple, big.join(small, ["k"]).select("k", "v", "w").collect()))
    assert sorted(map(tuple, plan.select("k", "v", "w").collect())) == want


def test_copies_of_the_small_side_follow_the_heavy_keys(spark, monkeypatch):
    seen = {}
    original = joins.heavy_keys

    def spy(df, on, lanes=None):
        seen["heavy"] = original(df, on, 64)
        return seen["heavy"]
    monkeypatch.setattr(joins, "heavy_keys", spy)
    monkeypatch.setattr(joins, "LEAST_ROWS", 10)
    big = spark.range(1000).select(F.lit(1).alias("b"), F.col("id").alias("v"))
    small = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "b int, w string")
    assert joins.product_join(big, small, ["b"]).count() == 1000
    assert seen["heavy"] == [(1, 64)]                                        # keys 2 and 3 have one copy


def test_nulls_no_heavy_keys_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(joins, "LEAST_ROWS", 2)
    big = spark.createDataFrame([(None, 1)] * 20 + [(1, 2)] * 9 + [(2, 3)], "k int, v int")
    small = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n"), (3, "c")], "k int, w string")
    got = joins.spread_join(big, small, ["k"])
    assert sorted(r.w for r in got.collect()) == ["a"] * 9 + ["b"] * 9
    assert joins.heavy_keys(big.limit(0), ["k"]) == []
    assert joins.spread_join(big.limit(0), small, ["k"]).count() == 0
