"""Topics, messages, attachments and topic statistics (F28-F32): the big tables.

Scale notes
-----------
* Numbers first, payload last: joins and the numbering shuffle carry narrow rows (ids, flags,
  dates).  Subject, Summary and Body are joined once, on ``ContentID``, to numbered rows;
  attachment bytes likewise, on their own hash.
* The narrow columns of the content table are staged once (``Migration.content_rows``) and read
  by three statements.
* Topics without a reply have no last author: they are split off before the lookups, so that no
  reducer gets them all under one NULL key.
* Portal users are resolved through ``user_map`` (one row per user); a prolific author is
  a hot join key on the content side, which AQE's skew-join splitting handles, and small
  maps are broadcast by AQE from runtime sizes.
* The insert-only merges on lineage columns drop every pre-existing target row at the
  scan (their lineage is NULL), so the anti joins only see this run's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flags import (LAST_MESSAGE_FLAGS, first_post_flags, reply_flags, topic_flags, topic_priority,
                               topic_status)
from ..functions.temporal import epoch_seconds_to_ts, shift_minutes
from ..functions.text import left, name_key
from ..operators.merge import update_from_aggregate
from .migration import Migration

c = F.col


def _shift(m: Migration, col):
    return shift_minutes(col, m.p.tz_offset_min, m.p.source_tz)


def _authors(m: Migration, prefix: str) -> DataFrame:
    um = m.user_map()
    return um.select(c("UserID").alias(f"{prefix}SrcID"), c("YUserID").alias(f"{prefix}UserID"),
                     c("YDisplayName").alias(f"{prefix}DisplayName"))


def _texts(m: Migration, key: str, **columns) -> Callable[[DataFrame], DataFrame]:
    """Joins text columns of the content table to numbered rows, on the content id in ``key``."""
    content = m.src["af_content"].select(c("ContentID").alias("_text_id"), *[e.alias(n) for n, e in columns.items()])
    return lambda rows: rows.join(content, c(key) == c("_text_id")).drop("_text_id")


# ------------------------------------------------------------------------- F28
def topics(m: Migration) -> None:
    src = m.src
    t = m.absent(src["af_topics"], "TopicID", "yaf_Topic")
    content = m.content_rows().select(c("ContentID").alias("CContentID"), "AuthorID", "DateCreated",
                                      c("IsDeleted").alias("CIsDeleted"))
    x = src["af_forum_topics"].select(c("TopicID").alias("XTopicID"), c("ForumID").alias("XForumID"),
                                      "LastReplyID", "LastReplyDate")
    forums = m.tgt["yaf_Forum"].filter(c("oForumID").isNotNull()).select(
        c("ForumID").alias("YForumID"), c("oForumID").alias("FoForumID"))
    base = (t.join(content, t.ContentID == content.CContentID)
             .join(x, t.TopicID == x.XTopicID)
             .join(forums, c("XForumID") == c("FoForumID"))
             .join(_authors(m, "A"), c("AuthorID") == c("ASrcID")))
    answered = _last_authors(m, base.filter(c("LastReplyID").isNotNull()))
    silent = base.filter(c("LastReplyID").isNull()).withColumns({
        "LUserID": F.lit(None).cast("bigint"), "LDisplayName": F.lit(None).cast("string")})
    rows = answered.unionByName(silent).select(
        c("YForumID").alias("ForumID"), c("AUserID").alias("UserID"), c("ADisplayName").alias("UserDisplayName"),
        _shift(m, c("DateCreated")).alias("Posted"), topic_status(c("StatusID")).alias("Status"),
        F.lit("").alias("Styles"), c("ViewCount").alias("Views"),
        topic_priority(c("IsAnnounce"), c("IsPinned")).alias("Priority"),
        _shift(m, epoch_seconds_to_ts(c("LastReplyDate"))).alias("LastPosted"),   # Q13
        c("LUserID").alias("LastUserID"), c("LDisplayName").alias("LastUserDisplayName"),
        F.lit(0).alias("NumPosts"),
        topic_flags(c("IsDeleted"), c("CIsDeleted"), c("IsLocked"), c("StatusID")).alias("Flags"),
        F.lit(0).alias("LastMessageFlags"), c("TopicID").alias("oTopicID"), c("ContentID").alias("_content"))
    # Q14: a topic listed in two forums is inserted twice (literal); the forum id breaks the tie
    m.merge("yaf_Topic", rows, ["oTopicID"], id_col="TopicID", id_order=["oTopicID", "ForumID"],
            attach=_texts(m, "_content", Topic=left("Subject", 100), Description=left("Summary", 255)))


def _last_authors(m: Migration, answered: DataFrame) -> DataFrame:
    """Who wrote a topic's last reply; a reply, its content or its author may be missing."""
    replies = m.src["af_replies"].select(c("ReplyID").alias("RReplyID"), c("ContentID").alias("RContentID"))
    written = m.content_rows().select(c("ContentID").alias("WContentID"), c("AuthorID").alias("WAuthorID"))
    return (answered.join(replies, c("LastReplyID") == c("RReplyID"), "left")
            .join(written, c("RContentID") == c("WContentID"), "left")
            .join(_authors(m, "L"), c("WAuthorID") == c("LSrcID"), "left")
            .drop("RReplyID", "RContentID", "WContentID", "WAuthorID", "LSrcID"))


# ------------------------------------------------------------------------- F29
def first_posts(m: Migration) -> None:
    src = m.src
    r = m.absent(src["af_topics"], "ContentID", "yaf_Message").select(
        c("TopicID").alias("RTopicID"), c("ContentID").alias("RContentID"), c("IsDeleted").alias("RIsDeleted"),
        "IsApproved", "IsLocked")
    content = m.content_rows().withColumnRenamed("IsDeleted", "CIsDeleted")
    yt = m.tgt["yaf_Topic"].filter(c("oTopicID").isNotNull()).select(c("TopicID").alias("YTopicID"), "oTopicID")
    narrow = (r.join(content, r.RContentID == content.ContentID)
               .join(yt, c("RTopicID") == c("oTopicID"))
               .join(_authors(m, "A"), c("AuthorID") == c("ASrcID"))
               .select(c("YTopicID").alias("TopicID"), F.lit(None).cast("bigint").alias("ReplyTo"),
                       F.lit(0).alias("Position"), F.lit(0).alias("Indent"), c("AUserID").alias("UserID"),
                       c("ADisplayName").alias("UserDisplayName"), _shift(m, c("DateCreated")).alias("Posted"),
                       c("IPAddress").alias("IP"),
                       first_post_flags(c("RIsDeleted"), c("CIsDeleted"), c("IsApproved"), c("IsLocked")).alias("Flags"),
                       F.lit(0).alias("IsModeratorChanged"), c("ContentID").alias("oContentID")))
    m.merge("yaf_Message", narrow, ["oContentID"], id_col="MessageID", id_order=["oContentID", "TopicID"],
            attach=_texts(m, "oContentID", Message=c("Body")))


# ------------------------------------------------------------------------- F30
def replies(m: Migration) -> None:
    """Replies hang below the topic's first post.  The reference joins every message of the
    topic (Q5): on a first run only the first post exists, which is what the default
    (``replies_to_first_post_only``) keeps on reruns too."""
    src = m.src
    r = m.absent(src["af_replies"], "ContentID", "yaf_Message").select(
        c("TopicID").alias("RTopicID"), c("ContentID").alias("RContentID"), c("IsDeleted").alias("RIsDeleted"),
        c("IsApproved").alias("RIsApproved"))
    content = m.content_rows().drop("IsDeleted")
    x = src["af_topics"].select(c("TopicID").alias("XTopicID"), c("IsLocked").alias("XIsLocked"))
    yt = m.tgt["yaf_Topic"].filter(c("oTopicID").isNotNull()).select(c("TopicID").alias("YTopicID"), "oTopicID")
    msgs = m.tgt["yaf_Message"]
    if m.p.replies_to_first_post_only:
        # a migrated topic's first post is a migrated one: parquet skips the old messages by null counts
        msgs = msgs.filter((c("Position") == F.lit(0)) & c("oContentID").isNotNull())
    msgs = msgs.select(c("TopicID").alias("MTopicID"), c("MessageID").alias("MMessageID"))
    narrow = (r.join(content, r.RContentID == content.ContentID)
               .join(x, c("RTopicID") == c("XTopicID"))
               .join(yt, c("RTopicID") == c("oTopicID"))
               .join(msgs, c("YTopicID") == c("MTopicID"))
               .join(_authors(m, "A"), c("AuthorID") == c("ASrcID"))
               .select(c("YTopicID").alias("TopicID"), c("MMessageID").alias("ReplyTo"), F.lit(1).alias("Position"),
                       F.lit(1).alias("Indent"), c("AUserID").alias("UserID"),
                       c("ADisplayName").alias("UserDisplayName"), _shift(m, c("DateCreated")).alias("Posted"),
                       c("IPAddress").alias("IP"),
                       reply_flags(c("RIsDeleted"), c("RIsApproved"), c("XIsLocked")).alias("Flags"),
                       F.lit(0).alias("IsModeratorChanged"), c("ContentID").alias("oContentID")))
    m.merge("yaf_Message", narrow, ["oContentID"], id_col="MessageID", id_order=["oContentID", "ReplyTo"],
            attach=_texts(m, "oContentID", Message=c("Body")))


# ------------------------------------------------------------------------- F31
def attachments(m: Migration) -> None:
    """Attachment -> migrated message (lineage) -> uploader on the board.  The reference does
    not scope the uploader to the board, so a name present on several boards multiplies
    the row (Q8); the board scope is applied by default.

    Joins and numbering see a hash in place of the file's bytes, which also makes the order of
    equally named files definite; the bytes are joined on content and hash at the end, each
    distinct file of a content row once.  The hash is never NULL, so the exchange that finds the
    distinct files is the one that the join needs too.  Narrow rows are staged, so the numbering
    does not read the bytes again."""
    digest = F.coalesce(F.sha2("FileData", 256), F.lit("none"))
    a = m._store(m.src["af_attachments"].withColumn("_file", digest).drop("FileData"), "attachments-narrow")
    files = m.src["af_attachments"].select("ContentID", digest.alias("_file"), "FileData").dropDuplicates(
        ["ContentID", "_file"]).withColumnRenamed("ContentID", "_content")
    msgs = m.tgt["yaf_Message"].filter(c("oContentID").isNotNull()).select(
        c("MessageID").alias("MMessageID"), c("oContentID").alias("MoContentID"))
    if m.p.board_scoped_attachment_authors:
        authors = _authors(m, "U")
    else:
        y = m.tgt["yaf_User"].select(c("UserID").alias("UUserID"), c("Name").alias("UName"))
        same = name_key("UserName", m.p.name_collation) == name_key("UName", m.p.name_collation)
        authors = m.src["users"].select(c("UserID").alias("USrcID"), "UserName").join(y, same).select("USrcID", "UUserID")
    rows = (a.join(msgs, a.ContentID == msgs.MoContentID)
             .join(authors, c("UserID") == c("USrcID"))
             .select(c("MMessageID").alias("MessageID"), c("UUserID").alias("UserID"), c("Filename").alias("FileName"),
                     c("FileSize").alias("Bytes"), "ContentType", F.lit(0).alias("Downloads"),
                     c("ContentID").alias("_content"), "_file"))
    m.merge("yaf_Attachment", rows, ["FileName", "MessageID"], id_col="AttachmentID",
            id_order=["MessageID", "FileName", "UserID", "Bytes", "ContentType", "_file"],
            attach=lambda numbered: numbered.join(files, ["_content", "_file"]))


# ------------------------------------------------------------------------- F32
def topic_statistics(m: Migration) -> None:
    """Topics with NumPosts = 0 take the count and highest id of their messages.  Neither side is
    scoped to the board (Q17), so a topic from before the run with NumPosts = 0 and messages is
    updated too.

    Messages are reduced to the open topics first (a semi join, which AQE broadcasts where the
    ids are few), so old messages of finished topics reach no aggregate.  The aggregate is partial
    (map-side): a topic holding a third of all messages costs one partial state per task.  Old
    topics that change become an overlay of these rows; the topic table is never rewritten.

    A resumed run also counts again the earlier topics that it gave messages, whose last reply
    is then another one too."""
    open_topics = m.tgt["yaf_Topic"].filter(c("NumPosts") == F.lit(0)).select("TopicID")
    if m.resumed:
        open_topics = open_topics.union(m.inserted_rows("yaf_Message").select("TopicID")).distinct()
    stats = m._store(_statistics(m.tgt["yaf_Message"], open_topics), "topic_stats")
    m.update("yaf_Topic", lambda t: _counted(t, stats))
    old = m.tgt.before_parts("yaf_Topic").join(stats.select("TopicID"), "TopicID", "left_semi")
    if m.resumed:
        changed = _replied(m, _counted(old, stats, where=F.lit(True)))
    else:
        changed = _counted(old.filter(c("NumPosts") == F.lit(0)), stats)
    m.overlay("yaf_Topic", "TopicID", changed)


def _replied(m: Migration, topics: DataFrame) -> DataFrame:
    """Earlier topics with their last reply looked up again; topics without lineage stay as they are."""
    listed = m.src["af_forum_topics"].select(c("TopicID").alias("oTopicID"), c("ForumID").alias("oForumID"), "LastReplyID",
                                             "LastReplyDate")
    forums = m.tgt["yaf_Forum"].filter(c("oForumID").isNotNull()).select("ForumID", "oForumID")
    found = topics.select("TopicID", "ForumID", "oTopicID").join(forums, "ForumID").join(listed, ["oTopicID", "oForumID"])
    found = _last_authors(m, found.select("TopicID", "LastReplyID", "LastReplyDate")).groupBy("TopicID").agg(
        F.max_by(F.struct(_shift(m, epoch_seconds_to_ts(c("LastReplyDate"))).alias("LastPosted"), c("LUserID").alias("LastUserID"),
                          c("LDisplayName").alias("LastUserDisplayName")), F.coalesce("LastReplyID", F.lit(-1))).alias("_last"))
    return update_from_aggregate(topics, found, ["TopicID"], {
        n: c(f"_last.{n}") for n in ("LastPosted", "LastUserID", "LastUserDisplayName")})


def _statistics(messages: DataFrame, topics: DataFrame) -> DataFrame:
    """Per topic among ``topics``: number and highest id of its messages."""
    own = messages.select("TopicID", "MessageID").join(topics, "TopicID", "left_semi")
    return own.groupBy("TopicID").agg(F.count(F.lit(1)).alias("_n"), F.max("MessageID").alias("_max_id"))


def _counted(topics: DataFrame, stats: DataFrame, where=None) -> DataFrame:
    return update_from_aggregate(
        topics, stats, ["TopicID"],
        {"NumPosts": c("_n"), "LastMessageID": c("_max_id"), "LastMessageFlags": F.lit(LAST_MESSAGE_FLAGS)},
        where=c("NumPosts") == F.lit(0) if where is None else where)
