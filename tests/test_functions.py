import datetime as dt

import pytest
from pyspark.sql import functions as F

from forumshift.functions import (epoch_seconds_to_ts, first_post_flags, left, name_guid, reply_flags,
                                  shift_minutes, to_smallint, topic_flags, topic_priority, topic_status)


def test_status_priority_and_flags_with_nulls(spark):
    rows = [(0, 0, 0, 0, 0, 0), (1, 1, 0, 1, 1, 0), (2, None, 1, 0, 0, 1), (3, 0, None, 1, None, 1),
            (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "status int, tdel int, cdel int, locked int, announce int, pinned int")
    out = df.select(topic_status(F.col("status")).alias("s"),
                    topic_flags(F.col("tdel"), F.col("cdel"), F.col("locked"), F.col("status")).alias("f"),
                    topic_priority(F.col("announce"), F.col("pinned")).alias("p")).collect()
    assert [r.s for r in out] == ["INFORMATIC", "QUESTION", "", "SOLVED", ""]
    assert [r.f for r in out] == [0, 8 + 1 + 1024, 8, 1, 0]
    assert [r.p for r in out] == [0, 2, 1, 1, 0]


def test_message_flags(spark):
    df = spark.createDataFrame([(1, 0, 1, 1), (0, 1, 0, 0), (None, None, None, None)], "a int, b int, c int, d int")
    fp = [r[0] for r in df.select(first_post_flags(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    rp = [r[0] for r in df.select(reply_flags(F.col("a"), F.col("c"), F.col("d"))).collect()]
    assert fp == [517 + 8 + 16 + 32, 517 + 8, 517]
    assert rp == [517 + 8 + 16 + 32, 517, 517]   # reply flags ignore content-deleted


def test_left_shift_epoch(spark):
    df = spark.createDataFrame([("abcdef", dt.datetime(2024, 1, 1, 0, 30), 86400), (None, None, None)],
                               "s string, ts timestamp_ntz, e bigint")
    out = df.select(left("s", 3).alias("l"), shift_minutes("ts", -60).alias("t"),
                    epoch_seconds_to_ts("e").alias("e")).collect()
    assert out[0].l == "abc" and out[0].t == dt.datetime(2023, 12, 31, 23, 30) and out[0].e == dt.datetime(1970, 1, 2)
    assert out[1].l is None and out[1].t is None and out[1].e is None
    assert dict(df.select(shift_minutes("ts", -60).alias("t")).dtypes)["t"] == "timestamp_ntz"


def test_smallint_cast_rules(spark):
    ok = spark.createDataFrame([("60",), ("",), ("  ",), (None,), ("-120",)], "v string")
    assert [r[0] for r in ok.select(to_smallint(F.col("v"))).collect()] == [60, 0, 0, None, -120]
    bad = spark.createDataFrame([("abc",)], "v string")
    with pytest.raises(Exception):
        bad.select(to_smallint(F.col("v"))).collect()
    assert bad.select(to_smallint(F.col("v"), tolerant=True)).first()[0] is None


def test_name_guid_is_deterministic(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    g1 = df.select(name_guid(F.col("x"), F.col("y"))).first()[0]
    g2 = df.select(name_guid(F.col("x"), F.col("y"))).first()[0]
    assert g1 == g2 and len(g1) == 36 and g1.count("-") == 4


def test_prefix_counts_utf16_units(spark):
    from forumshift.functions.text import left
    names = [None, "", "abc", "éèê" * 9, "𝟘𝟙𝟚", "x𝟘𝟙𝟚", "𝟘x𝟙x𝟚", "日本語𠀀字", "a" * 30, "\U0010ffff" * 20]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    for n in (1, 2, 3, 4, 5, 7, 20):
        got = [r[0] for r in df.select(left("s", n)).collect()]
        for name, x in zip(names, got):
            want = None if name is None else name.encode("utf-16-be")[:2 * n].decode("utf-16-be", "ignore")
            assert x == want, (name, n)


def test_permission_strings(spark):
    import pytest
    from forumshift.functions.permissions import grants, joined
    rows = [(1, "0;13;|1134;||"), (2, "|||"), (3, None), (4, "5:6; 7 ;|8"), (5, ""), (6, "1;|2;|3;|4;5;"), (7, "1;1;|||")]
    df = spark.createDataFrame(rows, "k int, p string")
    got = sorted(tuple(r) for r in grants(df, "p", "k").collect())
    assert got == [(1, "role", 0, 0), (1, "role", 1, 13), (1, "user", 0, 1134), (4, "role", 0, 5), (4, "role", 1, 6),
                   (4, "role", 2, 7), (4, "user", 0, 8), (6, "group_owner", 0, 3), (6, "other", 0, 4), (6, "other", 1, 5),
                   (6, "role", 0, 1), (6, "user", 0, 2), (7, "role", 0, 1), (7, "role", 1, 1)]
    back = {r.k: r.Permissions for r in joined(grants(df, "p", "k"), "k").collect()}
    assert back == {1: "0;13;|1134;||", 4: "5;6;7;|8;||", 6: "1;|2;|3;|4;5;", 7: "1;1;|||"}
    again = grants(spark.createDataFrame(list(back.items()), "k int, p string"), "p", "k")
    assert sorted(tuple(r) for r in again.collect()) == got
    for bad in ("1;|2;|3;|4;|5;", "x;|||"):
        with pytest.raises(Exception):
            grants(spark.createDataFrame([(1, bad)], "k int, p string"), "p", "k").collect()
