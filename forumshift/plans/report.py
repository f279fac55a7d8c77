"""Reports on a run (Q15).

``conservation``: for each migrated entity, how many source rows there were, how many reached the
new board and how many were rejected.  Source rows = migrated + rejected, always.

``reject_reasons``: the same source rows by the first lookup of their statement that has no row for
them (no content, no forum, no author, ...)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import name_key
from ..operators.rejects import Lookup, counts, first_failure
from .migration import Migration

c = F.col


def _row(entity: str, source: DataFrame, key: str, migrated_ids: DataFrame) -> DataFrame:
    """One row: rows of ``source`` and how many of them have their key among ``migrated_ids``."""
    ids = migrated_ids.select(c("_id").alias(key)).distinct()
    flagged = source.select(key).join(ids.withColumn("_hit", F.lit(1)), key, "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("SourceRows"),
        F.count("_hit").alias("MigratedRows"),
        F.count(F.when(c("_hit").isNull(), F.lit(1))).alias("RejectedRows"),
    ).select(F.lit(entity).alias("Entity"), "SourceRows", "MigratedRows", "RejectedRows")


def conservation(m: Migration) -> DataFrame:
    src = m.src
    lineage = lambda table, col: m.tgt[table].filter(c(col).isNotNull()).select(c(col).alias("_id"))
    groups = src["af_groups"].filter(c("ModuleID") == F.lit(m.p.module_id))
    forums = src["af_forums"].join(groups.select(c("ForumGroupID")), "ForumGroupID", "left_semi")
    msgs = m.tgt["yaf_Message"]
    users_on_board = m.user_map().select(c("UserID").alias("_id"))
    rows = [
        _row("users", src["users"], "UserID", users_on_board),
        _row("categories", groups, "ForumGroupID", lineage("yaf_Category", "oGroupID")),
        _row("forums", forums, "ForumID", lineage("yaf_Forum", "oForumID")),
        _row("topics", src["af_topics"], "TopicID", lineage("yaf_Topic", "oTopicID")),
        _row("first_posts", src["af_topics"], "ContentID",
             msgs.filter(c("Position") == 0).select(c("oContentID").alias("_id"))),
        _row("replies", src["af_replies"], "ContentID",
             msgs.filter(c("Position") == 1).select(c("oContentID").alias("_id"))),
    ]
    return reduce(DataFrame.unionByName, rows)


def _ids(df: DataFrame, col: str, name: str, **carried: str) -> DataFrame:
    """A lookup: the distinct values of ``col``, as ``name``, with columns that depend on it."""
    return df.select(c(col).alias(name), *[c(old).alias(new) for new, old in carried.items()]).filter(
        c(name).isNotNull()).dropDuplicates([name])


def rejected_rows(m: Migration) -> dict[str, DataFrame]:
    """Entity -> its source rows (narrow) with the reason why a row was not migrated.

    A row that reaches several targets (a topic listed in two forums) is migrated if one of them
    takes it: lookups are of distinct keys, so no row is multiplied."""
    src, tgt = m.src, m.tgt
    users, board = _ids(src["users"], "UserID", "_user"), _ids(m.user_map(), "UserID", "_board_user")

    def people(key: str, missing: str, absent: str) -> list[Lookup]:
        return [Lookup(missing, key, users, "_user"), Lookup(absent, key, board, "_board_user")]

    authors = people("_author", "no_author", "author_not_on_board")
    content = _ids(m.content_rows(), "ContentID", "_content", _author="AuthorID")
    topics = _ids(tgt["yaf_Topic"], "oTopicID", "_topic", _new_topic="TopicID")
    messages = tgt["yaf_Message"].filter(c("oContentID").isNotNull())
    forums = _ids(tgt["yaf_Forum"], "oForumID", "_forum")
    listed = src["af_forum_topics"].select("TopicID", "ForumID")
    placed = listed.join(forums, c("ForumID") == c("_forum"), "left_semi")
    opened = _ids(messages.filter(c("Position") == F.lit(0)), "TopicID", "_opened")

    collation = m.p.name_collation
    roles = src["roles"].filter(c("PortalID") == F.lit(m.scalars["portal_id"])).select("RoleID", "RoleName")
    groups = m.board_rows("yaf_Group").select(c("Name").alias("_group"))
    grouped = roles.join(groups, name_key("RoleName", collation) == name_key("_group", collation), "left_semi")

    return {
        "topics": first_failure(src["af_topics"].select("TopicID", "ContentID"), [
            Lookup("no_content", "ContentID", content, "_content"),
            Lookup("not_listed", "TopicID", _ids(listed, "TopicID", "_listed"), "_listed"),
            Lookup("forum_not_migrated", "TopicID", _ids(placed, "TopicID", "_placed"), "_placed"), *authors]),
        "first_posts": first_failure(src["af_topics"].select("TopicID", "ContentID"), [
            Lookup("no_content", "ContentID", content, "_content"),
            Lookup("topic_not_migrated", "TopicID", topics, "_topic"), *authors]),
        "replies": first_failure(src["af_replies"].select("ReplyID", "TopicID", "ContentID"), [
            Lookup("no_content", "ContentID", content, "_content"),
            Lookup("no_topic", "TopicID", _ids(src["af_topics"], "TopicID", "_old_topic"), "_old_topic"),
            Lookup("topic_not_migrated", "TopicID", topics, "_topic"),
            Lookup("no_first_post", "_new_topic", opened, "_opened"), *authors]),
        "attachments": first_failure(src["af_attachments"].select("ContentID", "UserID", "Filename"), [
            Lookup("post_not_migrated", "ContentID", _ids(messages, "oContentID", "_post"), "_post"),
            *people("UserID", "no_uploader", "uploader_not_on_board")]),
        "forum_watches": first_failure(src["af_forums_tracking"].select("ForumID", "UserID", "LastAccessDate"), [
            Lookup("forum_not_migrated", "ForumID", forums, "_forum"), *people("UserID", "no_user", "user_not_on_board")]),
        "topic_watches": first_failure(src["af_topics_tracking"].select("TopicID", "UserID", "DateAdded"), [
            Lookup("topic_not_migrated", "TopicID", topics, "_topic"), *people("UserID", "no_user", "user_not_on_board")]),
        "memberships": first_failure(src["user_roles"].select("UserID", "RoleID"), [
            Lookup("role_of_other_portal", "RoleID", _ids(roles, "RoleID", "_role"), "_role"),
            Lookup("no_group", "RoleID", _ids(grouped, "RoleID", "_grouped"), "_grouped"),
            *people("UserID", "no_user", "user_not_on_board")]),
    }


def reject_reasons(m: Migration) -> DataFrame:
    """(Entity, Reason, SourceRows); the reason of migrated rows is ``migrated``."""
    return reduce(DataFrame.unionByName, [counts(entity, rows) for entity, rows in rejected_rows(m).items()])
