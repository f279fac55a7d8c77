"""What joins send through the driver: by sizes measured at run time, not by those of files."""

from pyspark.sql import functions as F

from forumshift.operators.joins import spread_join
from forumshift.operators.merge import not_matched
from forumshift.operators.rejects import Lookup, first_failure
from forumshift.session import apply_run_conf


def _plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_small_files_of_many_rows_are_not_broadcast(spark, tmp_path):
    apply_run_conf(spark)
    spark.range(300_000).withColumn("s", F.lit("x")).write.parquet(f"{tmp_path}/a")
    a = spark.read.parquet(f"{tmp_path}/a")
    found = a.join(a.select((F.col("id") * 2).alias("id")), "id").agg(F.count(F.lit(1)).alias("n"))
    plan = _plan_of(found)
    assert found.first().n == 150_000
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_few_rows_of_several_keys_or_text_are_merged(spark):
    source = spark.createDataFrame([(1, 2, "a"), (1, 3, "b"), (None, 3, "c"), (1, 2, None)], "x long, y long, t string")
    target = spark.createDataFrame([(1, 2, "a"), (7, 7, None)], "x long, y long, t string")
    both = not_matched(source, target, ["x", "y"])
    assert sorted(r.t for r in both.collect()) == ["b", "c"]
    text = not_matched(source, target, ["t"])
    assert sorted(str(r.t) for r in text.collect()) == ["None", "b", "c"]
    assert "BroadcastHashJoin" not in _plan_of(both) + _plan_of(text)


def test_lanes_are_merged(spark, monkeypatch):
    from forumshift.operators import joins
    monkeypatch.setattr(joins, "LEAST_ROWS", 10)
    big = spark.range(500).select(F.lit(1).cast("long").alias("k"), "id")
    small = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, w string")
    got = spread_join(big, small, ["k"])
    plan = _plan_of(got)
    assert got.count() == 1000 and "SortMergeJoin" in plan


def test_lookups_of_rejects_are_merged(spark):
    source = spark.createDataFrame([(1, 10), (2, 10), (3, None), (None, 11)], "a long, b long")
    first = spark.createDataFrame([(1,), (3,)], "x long")
    second = spark.createDataFrame([(10,), (10,)], "y long").distinct()
    marked = first_failure(source, [Lookup("no_a", "a", first, "x"), Lookup("no_b", "b", second, "y")])
    assert sorted((str(r.a), r.Reason) for r in marked.collect()) == [("1", None), ("2", "no_a"), ("3", "no_b"), ("None", "no_a")]
    assert "BroadcastHashJoin" not in _plan_of(marked)
