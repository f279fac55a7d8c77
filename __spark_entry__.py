"""

Every query reads the driver tables through the fixture mapping
(``forumshift/sources/driver_fixture.py``) and returns the output of one migration flow
(SURVEY F-ids) over the *whole* tables.  One migration run per (session, folder) is kept
and advanced on demand; each query returns the snapshot of its flow, so results do not
depend on the order in which queries are called.  ``oracle_sql`` gives the same flows as
DuckDB SQL over the same tables (``forumshift/oracle.py``).
"""

from __future__ import annotations

import dataclasses
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumshift.operators.eav import duplicate_properties
from forumshift.operators.keys import assign_ids
from forumshift.oracle import ORACLE
from forumshift.plans.discovery import discover_boards
from forumshift.plans.migration import Migration
from forumshift.schemas import LINEAGE, TARGETS
from forumshift.session import apply_run_conf, checkpoint_dir
from forumshift.functions.permissions import grants, joined
from forumshift.functions.text import left
from forumshift.plans.crosswalk import crosswalk
from forumshift.sources.driver_fixture import (early_sources, fixture_params, fixture_sources, fixture_targets, old_posts)

SMOKE_DIR = "/root/testdata/sf0.001"
_RUNS: dict[tuple, Migration] = {}
_LOCK = threading.RLock()


# Option sets of the registered variants (literal run = "literal").
VARIANTS = {
    "literal": {},
    "full_depth": {"forum_full_depth": True},                    # Q3 + Q4
    "collated": {"name_collation": "UTF8_LCASE_RTRIM"},          # Q10
    "server_offset": {"tz_offset_min": None},                    # E3: the machine's own offset
    "beside_old": {},                                            # Q17: targets hold another board's posts
}


def migration(spark: SparkSession, sf_dir: str, upto: str, variant: str = "literal") -> Migration:
    key = (spark.sparkContext.applicationId, sf_dir, variant)
    with _LOCK:   # one run per key, advanced by one caller at a time
        m = _RUNS.get(key)
        if m is None:
            apply_run_conf(spark)
            params = dataclasses.replace(fixture_params(), **VARIANTS[variant])
            targets = fixture_targets(spark, sf_dir) | (old_posts(spark, sf_dir) if variant == "beside_old" else {})
            m = Migration(spark, fixture_sources(spark, sf_dir), targets, params)
            _RUNS[key] = m
        if upto not in m.done:
            m.run(upto=upto, parallel=True)
    return m


def resumed(spark: SparkSession, sf_dir: str) -> Migration:
    """The board migrated from what had been written early, then resumed with everything."""
    key = (spark.sparkContext.applicationId, sf_dir, "resumed")
    with _LOCK:
        if key not in _RUNS:
            apply_run_conf(spark)
            src = fixture_sources(spark, sf_dir)
            first = Migration(spark, early_sources(src), fixture_targets(spark, sf_dir), fixture_params()).run(parallel=True)
            known = first._store(crosswalk(first), "crosswalk")
            _RUNS[key] = Migration(spark, src, first.published(), fixture_params(), crosswalk=known).run(parallel=True)
        return _RUNS[key]


def _resumed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All posts of the resumed board, by source ids: equal to one full run."""
    m = resumed(spark, sf_dir)
    posts = m.tgt["yaf_Message"].filter("oContentID IS NOT NULL")
    topics = m.tgt["yaf_Topic"].select("TopicID", "oTopicID", "ForumID")
    above = posts.select(F.col("MessageID").alias("ReplyTo"), F.col("oContentID").alias("ParentContentID"))
    return posts.join(topics, "TopicID").join(above, "ReplyTo", "left").select(
        "oContentID", "oTopicID", "ForumID", "ParentContentID", "Position", "UserID", "UserDisplayName", "Posted", "Message", "Flags")


def _resumed_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = resumed(spark, sf_dir)
    last = m.tgt["yaf_Message"].filter("oContentID IS NOT NULL").select(
        F.col("MessageID").alias("LastMessageID"), F.col("oContentID").alias("LastContentID"))
    return m.tgt["yaf_Topic"].filter("oTopicID IS NOT NULL").join(last, "LastMessageID", "left").select(
        "oTopicID", "ForumID", "UserID", "Topic", "NumPosts", "LastPosted", "LastUserID", "LastUserDisplayName", "LastContentID",
        "LastMessageFlags")


def _resumed_forums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resumed(spark, sf_dir).tgt["yaf_Forum"].filter("oForumID IS NOT NULL").select(
        "ForumID", "oForumID", "NumTopics", "NumPosts", "LastPosted")


def _crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a full run leaves for the next one."""
    return crosswalk(migration(spark, sf_dir, "F36"))


def _utf16_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 over names whose digits are characters beyond U+FFFF, cut at every offset."""
    names = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.concat(
        F.repeat(F.lit("x"), (F.col("c_custkey") % 3).cast("int")),
        F.repeat(F.translate("c_name", "0123456789", "𝟘𝟙𝟚𝟛𝟜𝟝𝟞𝟟𝟠𝟡"), 3), F.lit("é")).alias("name"))
    return names.select("c_custkey", left("name", 50).alias("at_50"), left("name", 64).alias("at_64"), left("name", 255).alias("at_255"))


def _permissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey 2.12: a permission string per forum (one per customer): the role of the customer, three
    users, now and then an owner."""
    k = F.col("c_custkey")
    role = F.ascii("c_mktsegment") * 10 + F.col("c_nationkey") % 3
    text = F.concat(F.lit("0;"), role.cast("string"), F.lit(";|"), k.cast("string"), F.lit(";"), (k * 7 % 1000).cast("string"),
                    F.lit(":"), (k + 1_000_000).cast("string"), F.lit(";|"), F.when(k % 5 == 0, F.concat(k.cast("string"), F.lit(";")))
                    .otherwise(F.lit("")), F.lit("|"))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select((k + 1).alias("oForumID"), text.alias("Permissions"))


def _permission_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per grant, with the board's group or user of that id where there is one."""
    m = migration(spark, sf_dir, "F27")
    rows = grants(_permissions(spark, sf_dir), "Permissions", "oForumID")
    roles = m.src["roles"].join(m.board_rows("yaf_Group").select("GroupID", F.col("Name").alias("RoleName")), "RoleName")
    known = roles.select(F.lit("role").alias("Part"), F.col("RoleID").alias("ID"), F.col("GroupID").alias("NewID")).union(
        m.user_map().select(F.lit("user"), "UserID", "YUserID"))
    return rows.join(known, ["Part", "ID"], "left").select("oForumID", "Part", "Place", "ID", "NewID")


def _permission_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grants put back into strings."""
    return joined(grants(_permissions(spark, sf_dir), "Permissions", "oForumID"), "oForumID")


def _state(fid: str, table: str, cols: list, variant: str = "literal") -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return migration(spark, sf_dir, fid, variant).state(fid, table).select(*cols)
    return q


def _inserted(fids: tuple[str, ...], table: str, cols: list,
              variant: str = "literal") -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return migration(spark, sf_dir, fids[-1], variant).inserted_in(table, *fids).select(*cols)
    return q


def _published(table: str, cols: list) -> Callable[[SparkSession, str], DataFrame]:
    """a table as published; selecting from it fails if its lineage column is wanted."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = migration(spark, sf_dir, "F36").published()[table]
        assert LINEAGE[table] not in df.columns
        return df.selectExpr(*cols)
    return q


def _duplicate_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose profile flow gives more than one row (A5)."""
    eav = fixture_sources(spark, sf_dir)["user_profile"]
    return duplicate_properties(eav, "UserID", "PropertyDefinitionID")


def _topics_listed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics that F28 inserts more than once (Q14)."""
    listed = fixture_sources(spark, sf_dir)["af_forum_topics"].groupBy("TopicID").agg(F.count(F.lit(1)).alias("n"))
    return listed.filter("n > 1")


def _discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover_boards(fixture_sources(spark, sf_dir))


def _surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 on its own: dense ids in (user_id, ts, event_id) order over every event."""
    checkpoint_dir(spark)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts")
    return assign_ids(ev, "SurrogateID", ["user_id", "ts", "event_id"]).select("event_id", "user_id", "SurrogateID")


USER_COLS = [c for c in TARGETS["yaf_User"].fieldNames() if c != "AvatarImage"]     # never set, and binary
PROFILE_COLS = TARGETS["yaf_UserProfile"].fieldNames()
FORUM_COLS = ["ForumID", "CategoryID", "ParentID", "Name", "Description", "SortOrder", "LastPosted", "NumTopics",
              "NumPosts", "Flags", "IsModeratedNewTopicOnly", "oForumID"]
TOPIC_COLS = ["TopicID", "ForumID", "UserID", "UserDisplayName", "Posted", "Topic", "Description", "Status", "Styles",
              "Views", "Priority", "LastPosted", "LastUserID", "LastUserDisplayName", "NumPosts", "Flags",
              "LastMessageFlags", "oTopicID"]
MESSAGE_COLS = ["MessageID", "TopicID", "ReplyTo", "Position", "Indent", "UserID", "UserDisplayName", "Posted",
                "Message", "IP", "Flags", "IsModeratorChanged", "oContentID"]
STAT_COLS = ["TopicID", "ForumID", "NumPosts", "LastMessageID", "LastMessageFlags", "oTopicID"]
GROUP_COLS = ["GroupID", "BoardID", "Name", "Flags", "PMLimit", "Style", "SortOrder", "Description", "UsrSigChars",
              "UsrSigBBCodes", "UsrSigHTMLTags", "UsrAlbums", "UsrAlbumImages"]


def _attachments(variant: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = migration(spark, sf_dir, "F31", variant)
        return m.inserted_in("yaf_Attachment", "F31").select(
            "AttachmentID", "MessageID", "UserID", "FileName", "Bytes", "ContentType", "Downloads",
            F.md5("FileData").alias("FileDataMd5"))
    return q


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = migration(spark, sf_dir, "F36")
    return m.state("F36", "yaf_Forum").select("ForumID", "CategoryID", "NumTopics", "NumPosts", "LastPosted",
                                              "LastTopicID", "LastMessageID", "LastUserID", "LastUserDisplayName")


def _full_depth_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 option: the child-forum hop repeated until it inserts nothing, matched on source ids."""
    return migration(spark, sf_dir, "F27", "full_depth").state("F27", "yaf_Forum").select(*FORUM_COLS)


def _published_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the message table as published -- lineage column dropped."""
    m = migration(spark, sf_dir, "F36")
    return m.published()["yaf_Message"].select(*[c for c in MESSAGE_COLS if c != "oContentID"])


def _conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forumshift.plans.report import conservation
    return conservation(migration(spark, sf_dir, "F36"))


def _reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q15: source rows by entity and by the first lookup that has no row for them."""
    from forumshift.plans.report import reject_reasons
    return reject_reasons(migration(spark, sf_dir, "F36"))


try:   # the training-data operators are an optional part of the library
    from forumshift.llm import queries as _llm
except ModuleNotFoundError as missing:
    if missing.name not in ("forumshift.llm", "corpus_pipeline"):
        raise
    _llm = None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **(_llm.queries() if _llm else {}),
        "discover_boards": _discover,
        "create_board": _state("F02", "yaf_Board", ["BoardID", "Name", "AllowThreaded", "MembershipAppName",
                                                    "RolesAppName", "oModuleID"]),
        "board_groups": _state("F05", "yaf_Group", GROUP_COLS),
        "clone_smileys": _state("F07", "yaf_Smiley", ["SmileyID", "BoardID", "Code", "Icon", "Emoticon", "SortOrder"]),
        "clone_spam_words": _state("F08", "yaf_Spam_Words", ["ID", "BoardID", "SpamWord"]),
        "clone_replace_words": _state("F09", "yaf_Replace_Words", ["ID", "BoardID", "BadWord", "GoodWord"]),
        "clone_extensions": _state("F10", "yaf_Extension", ["ExtensionID", "BoardID", "Extension"]),
        "clone_bbcodes": _state("F11", "yaf_BBCode", ["BBCodeID", "BoardID", "Name", "Description", "OnClickJS",
                                                      "DisplayJS", "EditJS", "DisplayCSS", "SearchRegex",
                                                      "ReplaceRegex", "Variables", "UseModule", "ModuleClass",
                                                      "ExecOrder"]),
        "clone_topic_status": _state("F12", "yaf_TopicStatus", ["TopicStatusID", "BoardID", "TopicStatusName",
                                                                "DefaultDescription"]),
        "clone_registry": _state("F13", "yaf_Registry", ["RegistryID", "BoardID", "Name", "Value"]),
        "asp_roles": _state("F14", "aspnet_Roles", ["ApplicationID", "RoleID", "RoleName", "LoweredRoleName",
                                                    "Description"]),
        "access_masks": _state("F03", "yaf_AccessMask", TARGETS["yaf_AccessMask"].fieldNames()),
        "ranks": _state("F06", "yaf_Rank", TARGETS["yaf_Rank"].fieldNames()),
        "users_collated": _inserted(("F15", "F16"), "yaf_User", USER_COLS, "collated"),
        "server_offset": _inserted(("F26",), "yaf_Forum", ["oForumID", "LastPosted"], "server_offset"),
        "duplicate_properties": _duplicate_properties,
        "topics_listed_twice": _topics_listed_twice,
        "published_boards": _published("yaf_Board", ["BoardID", "Name", "AllowThreaded", "MembershipAppName",
                                                     "RolesAppName"]),
        "published_categories": _published("yaf_Category", ["CategoryID", "BoardID", "Name", "CategoryImage",
                                                            "SortOrder", "PollGroupID"]),
        "published_forums": _published("yaf_Forum", ["ForumID", "CategoryID", "Name",
                                                     "CAST(NumTopics AS BIGINT) AS NumTopics",
                                                     "CAST(NumPosts AS BIGINT) AS NumPosts"]),
        "published_topics": _published("yaf_Topic", ["TopicID", "ForumID", "UserID", "Topic", "NumPosts",
                                                     "LastMessageID"]),
        "users_insert_only": _inserted(("F15", "F16"), "yaf_User", USER_COLS),
        "user_profiles_eav": _inserted(("F17",), "yaf_UserProfile", PROFILE_COLS),
        "memberships": _state("F21", "yaf_UserGroup", ["UserID", "GroupID"]),
        "raise_flags": _state("F23", "yaf_User", ["UserID", "BoardID", "Name", "Flags"]),
        "user_role_links": _state("F24", "aspnet_UsersInRoles", ["UserID", "RoleID"]),
        "categories": _state("F25", "yaf_Category", ["CategoryID", "BoardID", "Name", "CategoryImage", "SortOrder",
                                                     "PollGroupID", "oGroupID"]),
        "forum_parents": _inserted(("F26",), "yaf_Forum", FORUM_COLS),
        "forum_tree": _state("F27", "yaf_Forum", FORUM_COLS),
        "topics": _inserted(("F28",), "yaf_Topic", TOPIC_COLS),
        "first_posts": _inserted(("F29",), "yaf_Message", MESSAGE_COLS),
        "replies": _inserted(("F30",), "yaf_Message", MESSAGE_COLS),
        "attachments": _attachments("literal"),
        "topic_stats": _state("F32", "yaf_Topic", STAT_COLS),
        "replies_beside_old": _inserted(("F30",), "yaf_Message", MESSAGE_COLS, "beside_old"),
        "attachments_beside_old": _attachments("beside_old"),
        "topic_stats_beside_old": _state("F32", "yaf_Topic", STAT_COLS, "beside_old"),
        "resumed_messages": _resumed_messages,
        "resumed_topics": _resumed_topics,
        "resumed_forums": _resumed_forums,
        "crosswalk": _crosswalk,
        "utf16_prefixes": _utf16_prefixes,
        "permission_grants": _permission_grants,
        "permission_strings": _permission_strings,
        "watch_forum": _inserted(("F33",), "yaf_WatchForum", ["WatchForumID", "ForumID", "UserID", "Created",
                                                             "LastMail"]),
        "watch_topic": _inserted(("F34",), "yaf_WatchTopic", ["WatchTopicID", "TopicID", "UserID", "Created",
                                                             "LastMail"]),
        "forum_access": _inserted(("F35",), "yaf_ForumAccess", ["GroupID", "ForumID", "AccessMaskID"]),
        "forum_rollup": _rollup,
        "surrogate_keys": _surrogate_keys,
        "conservation_report": _conservation,
        "reject_reasons": _reject_reasons,
        "forum_tree_full_depth": _full_depth_tree,
        "published_messages": _published_messages,
    }


def oracle_sql() -> dict[str, str]:
    return {**ORACLE, **(_llm.oracle_sql() if _llm else {})}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: every message of the migrated board (first posts and replies, F29+F30)."""
    m = migration(spark, SMOKE_DIR, "F30")
    return m.state("F30", "yaf_Message").select(*MESSAGE_COLS)
