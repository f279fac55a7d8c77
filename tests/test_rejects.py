"""Reject reasons (Q15)."""

from pyspark.sql import functions as F

from forumshift.operators.rejects import Lookup, counts, first_failure
from forumshift.plans.migration import Migration
from forumshift.plans.report import reject_reasons, rejected_rows
from forumshift.sources import fixture_params, fixture_sources, fixture_targets
from conftest import SF_SMALL


def test_first_failing_lookup_names_the_reason(spark):
    rows = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 40), (5, 50), (5, 50), (6, 10)], "id long, a long")
    first = spark.createDataFrame([(10, 100), (20, None), (50, 500), (None, 7)], "ka long, b long")
    second = spark.createDataFrame([(100,), (None,)], "kb long")
    got = first_failure(rows, [Lookup("no_a", "a", first, "ka"), Lookup("no_b", "b", second, "kb")])
    assert got.columns == ["id", "a", "Reason", "b"]
    assert sorted((r.id, r.Reason or "") for r in got.collect()) == [
        (1, ""), (2, "no_b"), (3, "no_a"), (4, "no_a"), (5, "no_b"), (5, "no_b"), (6, "")]
    assert {(r.Reason, r.SourceRows) for r in counts("x", got).collect()} == {("migrated", 2), ("no_a", 2), ("no_b", 3)}
    assert counts("x", got.limit(0)).count() == 0


def test_rows_without_a_key_do_not_meet_in_one_task(spark):
    rows = spark.range(20_000).select("id", F.lit(None).cast("long").alias("k"))
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = first_failure(rows, [Lookup("none", "k", spark.range(5).select(F.col("id").alias("x")), "x")])
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep[0])
        spark.conf.set("spark.sql.adaptive.enabled", keep[1])
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 10_000


def test_every_reason_of_a_run(spark):
    """Sources edited so that each lookup fails for some row."""
    src = fixture_sources(spark, SF_SMALL)
    some = src["af_topics"].orderBy("TopicID").limit(4).collect()
    src["af_content"] = src["af_content"].filter(F.col("ContentID") != some[0].ContentID).withColumn(
        "AuthorID", F.when(F.col("ContentID") == some[1].ContentID, F.lit(10 ** 9)).otherwise(F.col("AuthorID")))
    src["af_forum_topics"] = src["af_forum_topics"].filter(F.col("TopicID") != some[2].TopicID)
    extra = src["af_replies"].limit(1).withColumns({"TopicID": F.lit(10 ** 9).cast("bigint"), "ReplyID": F.lit(-1).cast("bigint")})
    src["af_replies"] = src["af_replies"].unionByName(extra)
    m = Migration(spark, src, fixture_targets(spark, SF_SMALL), fixture_params()).run(parallel=True)
    rows = reject_reasons(m).collect()
    by = {(r.Entity, r.Reason): r.SourceRows for r in rows}
    assert by["topics", "no_content"] == 1 and by["topics", "no_author"] == 1 and by["topics", "not_listed"] == 1
    assert by["first_posts", "topic_not_migrated"] > 1 and by["replies", "no_topic"] == 1
    source = {"topics": "af_topics", "first_posts": "af_topics", "replies": "af_replies", "attachments": "af_attachments",
              "forum_watches": "af_forums_tracking", "topic_watches": "af_topics_tracking", "memberships": "user_roles"}
    for entity, table in source.items():
        assert sum(n for (e, _), n in by.items() if e == entity) == src[table].count(), entity
    assert by["topics", "migrated"] == m.tgt["yaf_Topic"].select("oTopicID").distinct().count()
    posts = m.tgt["yaf_Message"]
    assert by["replies", "migrated"] == posts.filter("Position = 1").select("oContentID").distinct().count()
    assert by["first_posts", "migrated"] == posts.filter("Position = 0").select("oContentID").distinct().count()
    gone = rejected_rows(m)["topics"].filter("Reason = 'no_content'").collect()
    assert [r.TopicID for r in gone] == [some[0].TopicID]
