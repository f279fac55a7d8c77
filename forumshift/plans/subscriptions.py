"""Subscriptions and administrator access."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import shift_minutes, ts_literal
from ..operators.joins import product_join
from .migration import Migration

c = F.col


def _watches(m: Migration, tracking: DataFrame, item: str, ts_col: str, target_table: str, lineage: str,
             target_id: str, out_ts: str) -> DataFrame:
    """max(ts) per (user, item), mapped to the board's ids.

    The tracking table (one row per visit) is pre-aggregated on its own ids *before* any
    shuffle-heavy join -- max is associative, so the result is the same -- and aggregated
    again after the id mapping, which is what the reference's GROUP BY on the new ids needs
    when two old ids map to one new id.
    """
    pre = tracking.groupBy(item, "UserID").agg(F.max(ts_col).alias("_last"))
    items = m.tgt[target_table].filter(c(lineage).isNotNull()).select(c(target_id).alias("NItemID"),
                                                                     c(lineage).alias("NLineage"))
    um = m.user_map().select(c("UserID").alias("USrcID"), "YUserID")
    grouped = (pre.join(items, pre[item] == items.NLineage)
                  .join(um, c("UserID") == c("USrcID"))
                  .groupBy(c("YUserID").alias("UserID"), c("NItemID").alias(target_id))
                  .agg(F.max("_last").alias("_last")))
    return grouped.select(target_id, "UserID",
                          shift_minutes(c("_last"), m.p.tz_offset_min, m.p.source_tz).alias("Created"),
                          ts_literal(m.p.run_ts).alias(out_ts))


def watch_forums(m: Migration) -> None:
    rows = _watches(m, m.src["af_forums_tracking"], "ForumID", "LastAccessDate", "yaf_Forum", "oForumID",
                    "ForumID", "LastMail")
    m.merge("yaf_WatchForum", rows, ["ForumID", "UserID"], id_col="WatchForumID", id_order=["ForumID", "UserID"])


def watch_topics(m: Migration) -> None:
    rows = _watches(m, m.src["af_topics_tracking"], "TopicID", "DateAdded", "yaf_Topic", "oTopicID",
                    "TopicID", "LastMail")
    m.merge("yaf_WatchTopic", rows, ["TopicID", "UserID"], id_col="WatchTopicID", id_order=["TopicID", "UserID"])


def forum_access(m: Migration) -> None:
    """Every forum of the board x (admin access masks x administrator groups): tables joined
    only through BoardID (J8).  The forums side is salted, never shuffled on the single
    BoardID value."""
    b = F.lit(m.board_id)
    masks = m.tgt["yaf_AccessMask"].filter((c("BoardID") == b) & (c("Flags") == F.lit(2047))).select(
        "BoardID", "AccessMaskID")
    groups = m.tgt["yaf_Group"].filter((c("BoardID") == b) & (c("Flags") == F.lit(1))).select("BoardID", "GroupID")
    grants = product_join(masks, groups, ["BoardID"])
    cats = m.tgt["yaf_Category"].filter(c("BoardID") == b).select("BoardID", "CategoryID")
    forums = m.tgt["yaf_Forum"].select("ForumID", "CategoryID").join(cats, "CategoryID")
    rows = product_join(forums, grants, ["BoardID"]).select(
        "GroupID", "ForumID", "AccessMaskID")
    m.merge("yaf_ForumAccess", rows, ["ForumID", "GroupID"])
