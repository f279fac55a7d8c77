import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from forumshift.operators import (add_lineage, assign_ids, drop_lineage, insert_only_merge, pivot_properties,
                                  product_join, resolve, update_from_aggregate, update_only_merge)


def test_insert_only_merge_semantics(spark):
    tgt = spark.createDataFrame([(1, 1, "a"), (2, 1, None), (3, 2, "a")], "ID bigint, BoardID bigint, W string")
    src = spark.createDataFrame([(2, "a"), (2, "a"), (2, None), (2, "b"), (2, "b")], "BoardID bigint, W string")
    res = insert_only_merge(tgt, src, ["BoardID", "W"], id_col="ID", id_order=["W"])
    rows = sorted((r.ID, r.BoardID, r.W) for r in res.table.collect())
    # (2,'a') exists; NULL key never matches; duplicates are all inserted; ids continue after max
    assert rows == [(1, 1, "a"), (2, 1, None), (3, 2, "a"), (4, 2, None), (5, 2, "b"), (6, 2, "b")]
    assert res.inserted.count() == 3


def test_insert_only_merge_scope_and_source_keys(spark):
    tgt = spark.createDataFrame([(1, "x")], "BoardID bigint, Name string")
    src = spark.createDataFrame([(2, "x", "x-long")], "BoardID bigint, Name string, Full string")
    # scoped to board 2: the board-1 row does not count as a match
    assert insert_only_merge(tgt, src, ["Name"], target_filter=F.col("BoardID") == 2).inserted.count() == 1
    assert insert_only_merge(tgt, src, ["Name"]).inserted.count() == 0
    # match on an extra source column (Q4: untruncated name)
    assert insert_only_merge(tgt, src, ["Name"], source_keys=["Full"]).inserted.count() == 1


def test_merge_twice_is_idempotent(spark):
    tgt = spark.createDataFrame([(1, "a")], "ID bigint, K string")
    src = spark.createDataFrame([("b",), ("c",)], "K string")
    once = insert_only_merge(tgt, src, ["K"], id_col="ID", id_order=["K"]).table
    twice = insert_only_merge(once, src, ["K"], id_col="ID", id_order=["K"]).table
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_assign_ids_equals_global_row_number(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "user_id")
    shuffled = ev.repartition(7, "user_id")   # input order is not deterministic
    got = assign_ids(shuffled, "id", [F.col("user_id").desc(), "event_id"], base=10, num_partitions=5)
    want = ev.withColumn("want", F.row_number().over(Window.orderBy(F.col("user_id").desc(), "event_id")) + 10)
    joined = got.join(want, ["event_id"])
    assert joined.count() == ev.count()
    assert joined.filter("id != want").count() == 0


def test_update_only_merge(spark):
    tgt = spark.createDataFrame([(1, 2), (2, 98), (3, None), (4, 2)], "UserID bigint, Flags int")
    keys = spark.createDataFrame([(1,), (1,), (2,), (3,)], "UserID bigint")
    out = update_only_merge(tgt, keys, ["UserID"], {"Flags": F.lit(98)}, when=F.col("Flags") != 98)
    assert sorted(map(tuple, out.collect())) == [(1, 98), (2, 98), (3, None), (4, 2)]


def test_update_from_aggregate(spark):
    topics = spark.createDataFrame([(1, 0, None), (2, 5, None), (3, 0, None)], "TopicID bigint, NumPosts int, Last bigint")
    msgs = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "TopicID bigint, MessageID bigint")
    agg = msgs.groupBy("TopicID").agg(F.count(F.lit(1)).alias("n"), F.max("MessageID").alias("mx"))
    out = update_from_aggregate(topics, agg, ["TopicID"], {"NumPosts": F.col("n"), "Last": F.col("mx")},
                                where=F.col("NumPosts") == 0)
    assert sorted(map(tuple, out.collect())) == [(1, 2, 11), (2, 5, None), (3, 0, None)]


def test_lineage_columns(spark):
    df = spark.createDataFrame([(1,)], "ForumID bigint")
    with_l = add_lineage(df, "oForumID")
    assert with_l.columns == ["ForumID", "oForumID"] and add_lineage(with_l, "OFORUMID").columns == with_l.columns
    assert drop_lineage(with_l, "oforumid").columns == ["ForumID"]


def test_scalar_lookups_cardinality(spark):
    one = spark.createDataFrame([(5,)], "v int")
    none = one.filter("v < 0")
    two = spark.createDataFrame([(1,), (2,)], "v int")
    assert resolve(spark, {"a": one, "b": none}) == {"a": 5, "b": None}
    with pytest.raises(Exception):
        resolve(spark, {"c": two})


def test_pivot_properties(spark):
    eav = spark.createDataFrame([(1, 1, "x", None), (1, 2, None, "y"), (2, 2, None, "z"), (3, 9, "q", None)],
                                "UserID bigint, P bigint, V string, T string")
    out = pivot_properties(eav, "UserID", "P", {"A": (1, "V"), "B": (2, "T"), "C": (None, "V")})
    assert sorted(map(tuple, out.collect())) == [(1, "x", "y", None), (2, None, "z", None)]


def test_pivot_properties_keeps_every_combination(spark):
    eav = spark.createDataFrame([(1, 1, "x"), (1, 1, None), (1, 2, "p"), (1, 2, "q"), (2, 1, None)], "U bigint, P bigint, V string")
    out = pivot_properties(eav, "U", "P", {"A": (1, "V"), "B": (2, "V")})
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [
        (1, "x", "p"), (1, "x", "q"), (1, None, "p"), (1, None, "q"), (2, None, None)]))


def test_product_join_is_the_plain_join(spark):
    big = spark.range(0, 500).select(F.lit(7).alias("BoardID"), F.col("id").alias("UserID"))
    small = spark.createDataFrame([(7, 1), (7, 2), (8, 3)], "BoardID int, GroupID int")
    got = product_join(big, small, ["BoardID"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, big.join(small, "BoardID").collect()))
    assert got.count() == 1000


def test_strict_casts_do_not_depend_on_the_session(spark):
    from forumshift.functions import to_date_strict, to_smallint
    df = spark.createDataFrame([("abc",)], "t string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            for cast in (to_smallint, to_date_strict):
                with pytest.raises(Exception):
                    df.select(cast(F.col("t"))).collect()
                assert df.select(cast(F.col("t"), tolerant=True)).first()[0] is None
            assert df.select(to_smallint(F.lit(" ")), to_smallint(F.lit(" 7 "))).first() == (0, 7)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_collation_option_in_merge_keys(spark):
    from forumshift.operators.merge import not_matched
    tgt = spark.createDataFrame([("Alice",)], "Name string")
    src = spark.createDataFrame([("alice ",), ("Bob",)], "Name string")
    assert not_matched(src, tgt, ["Name"]).count() == 2                      # binary: no match
    left = not_matched(src, tgt, ["Name"], collation="UTF8_LCASE_RTRIM")     # Q10 option
    assert [r.Name for r in left.collect()] == ["Bob"]


def test_not_in_is_null_aware(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "RoleID bigint")
    no_null = spark.createDataFrame([(2,)], "RoleID bigint")
    with_null = spark.createDataFrame([(2,), (None,)], "RoleID bigint")
    assert sorted(r[0] for r in a.filter(~F.col("RoleID").isin(no_null)).collect()) == [1]
    assert a.filter(~F.col("RoleID").isin(with_null)).count() == 0
    assert a.filter(~F.col("RoleID").isin(no_null.limit(0))).count() == 3


def test_not_in_operator_matches_sql_rules(spark):
    from forumshift.operators import not_in
    a = spark.createDataFrame([(1,), (2,), (None,)], "RoleID bigint")
    no_null = spark.createDataFrame([(2,), (2,)], "RoleID bigint")
    with_null = spark.createDataFrame([(2,), (None,)], "RoleID bigint")
    for values in (no_null, with_null, no_null.limit(0)):
        want = sorted(map(repr, a.filter(~F.col("RoleID").isin(values)).collect()))
        assert sorted(map(repr, not_in(a, "RoleID", values).collect())) == want


def test_collation_leaves_other_keys_alone(spark):
    from forumshift.operators.merge import not_matched
    tgt = spark.createDataFrame([(1, "Alice")], "B bigint, Name string")
    src = spark.createDataFrame([(1, "ALICE "), (2, "alice")], "B bigint, Name string")
    assert [r.B for r in not_matched(src, tgt, ["B", "Name"], collation="UTF8_LCASE_RTRIM").collect()] == [2]


def test_assign_ids_uses_session_partitions_and_empty_tables(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "user_id")
    got = assign_ids(ev, "id", ["user_id", "event_id"], base=3)
    want = ev.withColumn("want", F.row_number().over(Window.orderBy("user_id", "event_id")) + 3)
    assert got.join(want, ["event_id"]).filter("id != want").count() == 0
    assert got.count() == ev.count()
    assert assign_ids(ev.limit(0), "id", ["event_id"]).count() == 0


def test_update_by_two_different_rows_is_an_error(spark):
    target = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, f int")
    twice = spark.createDataFrame([(1, 5), (2, 7), (2, 7), (9, 1), (9, 2)], "id int, new int")
    got = update_only_merge(target, twice, ["id"], {"f": F.col("new")})
    assert sorted(map(tuple, got.collect())) == [(1, 5), (2, 7), (3, 30)]       # equal rows update once; 9 updates none
    for other in (8, None):
        clash = twice.union(spark.createDataFrame([(2, other)], "id int, new int"))
        with pytest.raises(Exception, match="several source rows of different values"):
            update_only_merge(target, clash, ["id"], {"f": F.col("new")}).collect()
        spared = update_only_merge(target, clash, ["id"], {"f": F.col("new")}, when=F.col("f") != 20)
        assert sorted(map(tuple, spared.collect())) == [(1, 5), (2, 20), (3, 30)]
    with pytest.raises(ValueError, match="columns of both sides"):
        update_only_merge(target, twice.withColumnRenamed("new", "f"), ["id"], {"f": F.lit(1)})
