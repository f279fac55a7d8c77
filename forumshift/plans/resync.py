"""F36, re-aimed: the board resynchronisation the reference delegates to a stored procedure
whose body it does not contain.

What it must fill is known from the flows: forums are inserted with LastTopicID,
LastMessageID, LastUserID and LastUserDisplayName NULL and with the *source* totals.  Per
forum of the board this rollup sets NumTopics / NumPosts from the migrated topics and
messages and the Last* columns from the latest message (by Posted, then MessageID).

Messages are reduced per topic first (count + ``max_by``, both partial aggregates), then
per forum -- so the message table is shuffled once, as small per-topic states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.merge import update_from_aggregate
from .migration import Migration

c = F.col


def forum_rollup_frame(m: Migration) -> DataFrame:
    b = F.lit(m.board_id)
    cats = m.tgt["yaf_Category"].filter(c("BoardID") == b).select("CategoryID")
    forums = m.tgt["yaf_Forum"].join(cats, "CategoryID", "left_semi").select("ForumID")
    # the board's forums, topics and messages have lineage; other boards' rows drop out at the scan
    topics = m.tgt["yaf_Topic"].filter(c("oTopicID").isNotNull()).select("TopicID", c("ForumID").alias("TForumID"))
    latest = F.struct(c("Posted"), c("MessageID"))
    per_topic = m.tgt["yaf_Message"].filter(c("oContentID").isNotNull()).groupBy("TopicID").agg(
        F.count(F.lit(1)).alias("_posts"),
        F.max_by(F.struct("Posted", "MessageID", "UserID", "UserDisplayName"), latest).alias("_lt"))
    last = F.when(c("_lt").isNotNull(), F.struct(
        c("_lt.Posted").alias("Posted"), c("_lt.MessageID").alias("MessageID"), c("_lt.UserID").alias("UserID"),
        c("_lt.UserDisplayName").alias("UserDisplayName"), c("TopicID").alias("TopicID")))
    order = F.when(c("_lt").isNotNull(), F.struct(c("_lt.Posted"), c("_lt.MessageID")))
    return (forums.join(topics, forums.ForumID == topics.TForumID, "left")
                  .join(per_topic, "TopicID", "left")
                  .groupBy("ForumID").agg(
                      F.count("TopicID").cast("int").alias("_topics"),
                      F.coalesce(F.sum("_posts"), F.lit(0)).cast("int").alias("_posts"),
                      F.max_by(last, order).alias("_last")))


def forum_rollup(m: Migration) -> None:
    roll = m._store(forum_rollup_frame(m), "forum_rollup")


    def filled(t: DataFrame) -> DataFrame:
        return update_from_aggregate(t, roll, ["ForumID"], {
            "NumTopics": c("_topics"), "NumPosts": c("_posts"),
            "LastPosted": c("_last.Posted"), "LastTopicID": c("_last.TopicID"), "LastMessageID": c("_last.MessageID"),
            "LastUserID": c("_last.UserID"), "LastUserDisplayName": c("_last.UserDisplayName")})

    # only forums of the board are keyed: those of this run, and in a resumed run the earlier ones
    m.update("yaf_Forum", filled)
    if m.resumed:
        m.overlay("yaf_Forum", "ForumID", filled(m.tgt.before_parts("yaf_Forum").join(roll.select("ForumID"), "ForumID", "left_semi")))
