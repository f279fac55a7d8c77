"""Source shapes (S01-S24) and the initial target state, built from the driver tables.

The reference ships no data, so its inputs are derived from the driver's generated tables
(``customer``, ``conversations``, ``events``, ``pages``, ``part``, ``supplier``, ``nation``,
``region``).  Every mapping keeps all rows of the driver table it reads: moduli below only
*assign* rows or values (to forums, users, boards, or NULL for an absent property); they never
select a subset.  The only row filters are semantic: the first turn of a conversation opens
the topic, later turns are its replies.  Tiny configuration tables (property definitions,
list entries, the template board's groups/ranks/masks and its guest user) are literal rows,
as they are configuration rather than data.

The same mapping is written in SQL in ``forumshift/oracle.py`` for the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.temporal import ts_literal
from ..functions.text import guid_from_hex
from ..params import RunParams
from ..schemas import SOURCES, TARGETS, conform, empty

# Fixed values of the fixture world.
MODULE_ID = 0                 # the forum module being migrated
TEMPLATE_BOARD = 1
TZ_OFFSET_MIN = -60
RUN_TS = dt.datetime(2024, 2, 1, 0, 0, 0)
BASE_TS = dt.datetime(2024, 1, 1, 0, 0, 0)
USER_TS = dt.datetime(2023, 6, 1, 0, 0, 0)
EPOCH_2024 = 1704067200
APP_GUID = "6f1c2a9e-0d4b-4c1e-9a51-3b7f0e2d8c41"
LONG_NAME = "Announcements and discussions for every member of "   # 50 characters: stored names end here

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "events", "pages", "conversations")


def fixture_params() -> RunParams:
    return RunParams(module_id=MODULE_ID, template_board_id=TEMPLATE_BOARD, tz_offset_min=TZ_OFFSET_MIN,
                     run_ts=RUN_TS)


OLD_FORUMS = 3_000_000_000


def _read(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in DRIVER_TABLES}


def _minutes(base: dt.datetime, n) -> F.Column:
    return F.timestamp_add("MINUTE", n, ts_literal(base))


def _seconds(base: dt.datetime, n) -> F.Column:
    return F.timestamp_add("SECOND", n, ts_literal(base))


def _int(cond: F.Column) -> F.Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def _role_id() -> F.Column:
    return F.ascii("c_mktsegment").cast("bigint") * 10 + F.col("c_nationkey") % 3


def fixture_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    d = _read(spark, sf_dir)
    nation, region, customer, supplier = d["nation"], d["region"], d["customer"], d["supplier"]
    conv, events, pages = d["conversations"], d["events"], d["pages"]
    c = F.col
    src: dict[str, DataFrame] = {}
    # keys are spread over all customers (one forum each) and all conversations (one topic each)
    n_forums = customer.agg((F.max("c_custkey") + 1).alias("n")).scalar()
    n_topics = conv.agg((F.max("conv_id") + 1).alias("n")).scalar()

    src["modules"] = nation.select(c("n_nationkey").alias("ModuleID"), c("n_regionkey").alias("PortalID"))
    src["portals"] = region.select(c("r_regionkey").alias("PortalID"),
                                   ((c("r_regionkey") - 2) * 60).alias("TimezoneOffset"))
    src["tabs"] = nation.select(c("n_nationkey").alias("TabID"), c("n_regionkey").alias("PortalID"),
                                F.concat(F.lit("//"), c("n_name")).alias("TabPath"))
    src["tab_modules"] = supplier.select(c("s_suppkey").alias("TabModuleID"), (c("s_suppkey") % 25).alias("ModuleID"),
                                         (c("s_suppkey") % 25).alias("TabID"), c("s_name").alias("ModuleTitle"))
    src["module_settings"] = customer.select(
        (c("c_custkey") % 25).alias("ModuleID"),
        F.when(c("c_mktsegment") == "BUILDING", F.lit("MODE")).otherwise(c("c_mktsegment")).alias("SettingName"),
        F.when(c("c_acctbal") >= 0, F.lit("Standard")).otherwise(F.lit("SocialGroups")).alias("SettingValue"))
    src["roles"] = customer.select(_role_id().alias("RoleID"), c("c_mktsegment").alias("RoleName"),
                                   (c("c_nationkey") % 3).alias("PortalID")).distinct()
    src["module_permission"] = customer.select((c("c_custkey") % 25).alias("ModuleID"),
                                               _role_id().alias("RoleID")).distinct()
    src["user_roles"] = customer.select(c("c_custkey").alias("UserID"), _role_id().alias("RoleID"))
    src["users"] = customer.select(
        c("c_custkey").alias("UserID"), F.when(c("c_custkey") % 50 != 13, c("c_name")).alias("UserName"),
        F.replace(c("c_name"), F.lit("Customer#"), F.lit("Member ")).alias("DisplayName"),
        F.concat(F.lower(F.replace(c("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.org")).alias("Email"),
        _int(c("c_custkey") % 100 == 0).alias("IsSuperUser"),
        _minutes(USER_TS, c("c_custkey")).alias("LastModifiedOnDate"))
    # some accounts are spelled differently: equal only under a collation (Q10)
    account = F.when(c("c_custkey") % 16 == 3, F.concat(F.upper("c_name"), F.lit(" "))).otherwise(c("c_name"))
    src["aspnet_users"] = customer.select(guid_from_hex(F.md5(c("c_name"))).alias("UserId"), account.alias("UserName"))

    cid = c("c_custkey")
    # One row per customer and property; a property a user does not have is a NULL value,
    # which the flows treat exactly like a missing row (left join + IsNull default).
    tz = customer.select(
        cid.alias("UserID"), F.lit(1).alias("PropertyDefinitionID"),
        F.when(cid % 2 == 0, F.when(cid % 10 == 4, F.lit("")).otherwise(((cid % 5 - 2) * 60).cast("string")))
         .alias("PropertyValue"),
        F.lit(None).cast("string").alias("PropertyText"))
    bd = customer.select(
        cid.alias("UserID"), F.lit(2).alias("PropertyDefinitionID"),
        F.when(cid % 3 == 0, F.concat((1950 + cid % 50).cast("string"), F.lit("-"),
                                      F.lpad((1 + cid % 12).cast("string"), 2, "0"), F.lit("-"),
                                      F.lpad((1 + cid % 28).cast("string"), 2, "0"), F.lit("T00:00:00")))
         .alias("PropertyValue"),
        F.lit(None).cast("string").alias("PropertyText"))
    cn = customer.select(cid.alias("UserID"), F.lit(3).alias("PropertyDefinitionID"),
                         F.lit(None).cast("string").alias("PropertyValue"),
                         F.concat(F.lit("Nation "), c("c_nationkey").cast("string")).alias("PropertyText"))
    rg = customer.select(cid.alias("UserID"), F.lit(4).alias("PropertyDefinitionID"),
                         F.lit(None).cast("string").alias("PropertyValue"),
                         F.when(cid % 2 == 1, c("c_mktsegment")).alias("PropertyText"))
    cy = customer.select(cid.alias("UserID"), F.lit(5).alias("PropertyDefinitionID"),
                         F.concat(F.lit("City "), (cid % 97).cast("string")).alias("PropertyValue"),
                         F.lit(None).cast("string").alias("PropertyText"))
    ws = customer.select(
        cid.alias("UserID"), F.lit(6).alias("PropertyDefinitionID"),
        F.when(cid % 4 == 0, F.concat(F.lit("https://example.org/u/"), cid.cast("string"))).alias("PropertyValue"),
        F.lit(None).cast("string").alias("PropertyText"))
    # some users hold a property twice
    cy2 = customer.filter(cid % 20 == 6).select(
        cid.alias("UserID"), F.lit(5).alias("PropertyDefinitionID"),
        F.when(cid % 40 == 6, F.lit("Second city")).alias("PropertyValue"), F.lit(None).cast("string").alias("PropertyText"))
    src["user_profile"] = (tz.unionByName(bd).unionByName(cn).unionByName(rg).unionByName(cy).unionByName(cy2)
                           .unionByName(ws))

    defs = [(1, 0, 99, "TimeZone"), (2, 0, 10, "Birthday"), (3, 0, 11, "Country"), (4, 0, 11, "Region"),
            (5, 0, 11, "City"), (6, 0, 11, "Website"), (7, 1, 99, "TimeZone"), (8, 1, 10, "Birthday"),
            (9, 1, 11, "Country"), (10, 1, 11, "Region"), (11, 1, 11, "City"), (12, 1, 11, "Website")]
    src["profile_property_definition"] = spark.createDataFrame(defs, SOURCES["profile_property_definition"])
    src["lists"] = spark.createDataFrame([(99, "DataType", "TimeZone"), (10, "DataType", "DateTime"),
                                          (11, "DataType", "Text"), (98, "Region", "TimeZone")], SOURCES["lists"])
    src["aspnet_applications"] = spark.createDataFrame(
        [(APP_GUID, "DotNetNuke"), ("0b9d4e77-5f6a-4a39-8c1d-2e6f7a8b9c0d", "OtherApp")], SOURCES["aspnet_applications"])

    ev = events.groupBy("user_id").agg(
        F.count(F.when(c("event_type") == "purchase", F.lit(1))).alias("n_topics"),
        F.count(F.when(c("event_type") == "view", F.lit(1))).alias("n_replies"),
        F.max("ts").alias("last_ts"))
    src["af_user_profiles"] = customer.join(ev, customer.c_custkey == ev.user_id, "left").select(
        cid.alias("UserID"), F.when(cid % 10 == 9, F.lit(1)).otherwise(F.lit(0)).alias("PortalID"),
        F.concat(F.lit("Regards, "), c("c_name")).alias("Signature"),
        F.when(cid % 2 == 0, F.concat(F.lit("avatar"), cid.cast("string"), F.lit(".png"))).alias("Avatar"),
        F.coalesce(c("n_topics"), F.lit(0)).alias("TopicCount"),
        F.coalesce(c("n_replies"), F.lit(0)).alias("ReplyCount"),
        c("last_ts").alias("DateLastActivity"))

    src["af_groups"] = nation.select((c("n_nationkey") + 1).alias("ForumGroupID"), F.lit(MODULE_ID).alias("ModuleID"),
                                     c("n_name").alias("GroupName"), c("n_nationkey").alias("SortOrder")).unionByName(
        region.select((c("r_regionkey") + 100).alias("ForumGroupID"), (c("r_regionkey") + 1).alias("ModuleID"),
                      c("r_name").alias("GroupName"), c("r_regionkey").alias("SortOrder")))
    # twelve forums at a time: a root, a chain of six below it, and five more right below it; two of
    # these have names that differ only after the stored length, and some have no name
    rank, block = cid % 12, F.floor(cid / 12)
    src["af_forums"] = customer.select(
        (cid + 1).alias("ForumID"), (block % 25 + 1).alias("ForumGroupID"),
        F.when(rank == 0, F.lit(0)).when(rank <= 6, cid).otherwise(cid - rank + 1).alias("ParentForumID"),
        F.when(cid % 40 == 17, F.lit(None).cast("string"))
         .when(rank.isin(8, 9), F.concat(F.lit(LONG_NAME), F.lit("group "), c("c_mktsegment"), cid.cast("string")))
         .otherwise(c("c_name")).alias("ForumName"),
        F.concat(F.lit("Forum of "), c("c_mktsegment"), F.lit(" customers in nation "),
                 c("c_nationkey").cast("string")).alias("ForumDesc"),
        _minutes(BASE_TS, cid).alias("LastPostDate"), (cid % 50).alias("TotalTopics"),
        ((cid % 7) * 3).alias("TotalReplies"), (cid % 10).alias("SortOrder"))

    k, t = c("conv_id"), c("turn")
    first = conv.filter(t == 0)
    src["af_topics"] = first.select(
        k.alias("TopicID"), (k * 100).alias("ContentID"), (k % 4).alias("StatusID"),
        _int(k % 11 == 5).alias("IsDeleted"), _int(k % 3 == 1).alias("IsLocked"),
        _int(k % 7 == 2).alias("IsAnnounce"), _int(k % 5 == 3).alias("IsPinned"),
        _int(k % 6 != 0).alias("IsApproved"), (F.length("text") % 1000).alias("ViewCount"))
    last = conv.groupBy("conv_id").agg(F.max("turn").alias("max_turn"))
    listed = last.withColumn("shift", F.explode(F.when(k % 9 == 4, F.array(F.lit(0), F.lit(14))).otherwise(
        F.array(F.lit(0)))))                       # some topics are listed in two forums (Q14)
    src["af_forum_topics"] = listed.select(
        ((k * 7 + c("shift")) % n_forums + 1).alias("ForumID"), k.alias("TopicID"),
        F.when(c("max_turn") > 0, k * 100 + c("max_turn")).alias("LastReplyID"),
        (F.lit(EPOCH_2024) + k * 3600).alias("LastTopicDate"),
        (F.lit(EPOCH_2024) + k * 3600 + c("max_turn") * 300).alias("LastReplyDate"))
    src["af_content"] = conv.select(
        (k * 100 + t).alias("ContentID"),
        F.when(c("role") == "system", F.lit(0)).otherwise((k * 7 + t) % n_forums).alias("AuthorID"),
        c("text").alias("Subject"), F.when(t % 2 == 0, c("text")).alias("Summary"), c("text").alias("Body"),
        _seconds(BASE_TS, k * 3600 + t * 300).alias("DateCreated"),
        F.concat(F.lit("10."), (k % 256).cast("string"), F.lit("."), t.cast("string"), F.lit(".1")).alias("IPAddress"),
        _int((k + t) % 13 == 0).alias("IsDeleted"))
    src["af_replies"] = conv.filter(t > 0).select(
        (k * 100 + t).alias("ReplyID"), k.alias("TopicID"), (k * 100 + t).alias("ContentID"),
        _int(t % 5 == 4).alias("IsDeleted"), _int(t % 3 != 0).alias("IsApproved"))
    p = c("page_id")
    src["af_attachments"] = pages.select(
        ((p % n_topics) * 100).alias("ContentID"), ((p * 7) % n_forums).alias("UserID"), c("url").alias("Filename"),
        F.encode(c("html"), "UTF-8").alias("FileData"), F.lit("text/html").alias("ContentType"),
        F.octet_length("html").alias("FileSize"))
    src["af_forums_tracking"] = events.select((c("event_id") % n_forums + 1).alias("ForumID"),
                                              c("user_id").alias("UserID"), c("ts").alias("LastAccessDate"))
    src["af_topics_tracking"] = events.select((c("event_id") % n_topics).alias("TopicID"),
                                              c("user_id").alias("UserID"), c("ts").alias("DateAdded"))
    return {name: conform(df, SOURCES[name], name=name) for name, df in src.items()}


def _group_row(gid, board, name, flags, pm, sort):
    return (gid, board, name, flags, pm, None, sort, "", 128, "URL,IMG", "", 0, 0)


def fixture_targets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    d = _read(spark, sf_dir)
    region, part, customer = d["region"], d["part"], d["customer"]
    c = F.col
    tgt: dict[str, DataFrame] = {}
    tgt["yaf_Board"] = region.select((c("r_regionkey") + 1).alias("BoardID"), c("r_name").alias("Name"),
                                     F.lit(1).alias("AllowThreaded"), F.lit("").alias("MembershipAppName"),
                                     F.lit("").alias("RolesAppName"))
    b = TEMPLATE_BOARD
    # five masks and ranks a board, in the order of the nations of its region
    nation, nth = d["nation"], F.expr("n_nationkey DIV 5").cast("int")
    board_of = (c("n_regionkey") + 1).alias("BoardID")

    def by_place(*values):
        out = F.lit(None)
        for k, v in enumerate(values):
            out = F.when(nth == k, F.lit(v)) if k == 0 else out.when(nth == k, F.lit(v))
        return out

    tgt["yaf_AccessMask"] = nation.select(
        (c("n_nationkey") + 1).alias("AccessMaskID"), board_of, F.concat(F.lit("Access of "), c("n_name")).alias("Name"),
        by_place(2047, 1023, 1017, 1, 0).alias("Flags"), nth.alias("SortOrder"))
    tgt["yaf_Group"] = spark.createDataFrame(
        [_group_row(1, b, "Administrators", 1, 30, 1), _group_row(2, b, "Guests", 2, 0, 2),
         _group_row(3, b, "Registered", 4, 30, 3), _group_row(4, b, "Moderators", 0, 30, 4)], TARGETS["yaf_Group"])
    tgt["yaf_Rank"] = nation.select(
        (c("n_nationkey") + 1).alias("RankID"), board_of, F.concat(F.lit("Rank of "), c("n_name")).alias("Name"),
        by_place(None, None, 0, 10, 30).cast("int").alias("MinPosts"), by_place(0, 0, 3, 2, 2).alias("Flags"),
        by_place(2147483647, 0, 10, 30, 100).alias("PMLimit"), (nth + 1).alias("SortOrder"), F.lit("").alias("Description"),
        by_place(128, 0, 128, 128, 256).alias("UsrSigChars"),
        by_place("URL,IMG", "", "URL", "URL,IMG", "URL,IMG").alias("UsrSigBBCodes"), F.lit("").alias("UsrSigHTMLTags"),
        by_place(0, 0, 0, 0, 5).alias("UsrAlbums"), by_place(0, 0, 0, 0, 10).alias("UsrAlbumImages"))

    pk = c("p_partkey")
    board = (pk % 5 + 1)
    tgt["yaf_Smiley"] = part.select(
        (pk + 1).alias("SmileyID"), board.alias("BoardID"),
        F.concat(F.lit(":"), F.lower(F.replace(c("p_brand"), F.lit("#"), F.lit(""))), F.lit(":")).alias("Code"),
        F.concat(F.lower(F.replace(c("p_type"), F.lit(" "), F.lit("_"))), F.lit(".gif")).alias("Icon"),
        c("p_name").alias("Emoticon"), c("p_size").alias("SortOrder"))
    tgt["yaf_Spam_Words"] = part.select((pk + 1).alias("ID"), board.alias("BoardID"), c("p_name").alias("SpamWord"))
    tgt["yaf_Replace_Words"] = part.select((pk + 1).alias("ID"), board.alias("BoardID"), c("p_brand").alias("BadWord"),
                                           c("p_type").alias("GoodWord"))
    tgt["yaf_Extension"] = part.select((pk + 1).alias("ExtensionID"), board.alias("BoardID"),
                                       F.lower(F.replace(c("p_brand"), F.lit("Brand#"), F.lit("ext"))).alias("Extension"))
    tgt["yaf_BBCode"] = part.select(
        (pk + 1).alias("BBCodeID"), board.alias("BoardID"), c("p_name").alias("Name"), c("p_type").alias("Description"),
        F.when(c("p_size") % 2 == 0, F.concat(F.lit("show("), c("p_size").cast("string"), F.lit(")"))).alias("DisplayJS"),
        F.concat(F.lit("["), c("p_brand"), F.lit("]")).alias("SearchRegex"),
        F.concat(F.lit("<span>"), c("p_brand"), F.lit("</span>")).alias("ReplaceRegex"),
        (c("p_size") % 2).alias("UseModule"), c("p_size").alias("ExecOrder"))
    tgt["yaf_TopicStatus"] = part.select((pk + 1).alias("TopicStatusID"), board.alias("BoardID"),
                                         c("p_type").alias("TopicStatusName"), c("p_name").alias("DefaultDescription"))
    tgt["yaf_Registry"] = part.select((pk + 1).alias("RegistryID"),
                                      F.when(pk % 10 == 9, F.lit(None)).otherwise(board).alias("BoardID"),
                                      F.concat(F.lit("setting."), c("p_brand")).alias("Name"), c("p_name").alias("Value"))
    tgt["aspnet_Roles"] = spark.createDataFrame(
        [(APP_GUID, "9a0e6c1d-7b2f-4e58-a3c4-5d6e7f809a1b", "Administrators", "administrators", None),
         (APP_GUID, "1b2c3d4e-5f60-4718-89ab-cdef01234567", "Registered", "registered", None)], TARGETS["aspnet_Roles"])
    joined = ts_literal(dt.datetime(2020, 1, 1))
    seed_users = spark.createDataFrame(
        [(1, b, None, "Guest", "Guest", "na", "guest@example.org", 0, 2, 6),
         (2, b, "5e6f7a8b-9c0d-4e1f-a2b3-c4d5e6f7a8b9", "admin", "Administrator", "na", "admin@example.org", 0, 1, 99)],
        "UserID bigint, BoardID bigint, ProviderUserKey string, Name string, DisplayName string, Password string, "
        "Email string, NumPosts int, RankID bigint, Flags int").withColumns({"Joined": joined, "LastVisit": joined})
    # every portal user already has an account on board 2 (same names on another board: Q8)
    board2 = customer.select(
        (F.lit(1_000_000_000) + c("c_custkey")).alias("UserID"), F.lit(2).alias("BoardID"),
        c("c_name").alias("Name"), c("c_name").alias("DisplayName"), F.lit("na").alias("Password"),
        F.lit(0).alias("NumPosts"), F.lit(2).alias("Flags"), joined.alias("Joined"), joined.alias("LastVisit"))
    tgt["yaf_User"] = seed_users.unionByName(board2, allowMissingColumns=True)
    tgt["yaf_UserGroup"] = spark.createDataFrame([(1, 2), (2, 1)], TARGETS["yaf_UserGroup"])
    out = {name: conform(df, TARGETS[name], fill=True) for name, df in tgt.items()}
    for name, schema in TARGETS.items():
        out.setdefault(name, empty(spark, schema))
    return out


def old_posts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Another board's topics, posts and files, as targets may hold them before a run: a topic per order,
    a post per line item, a file per page.  Every third topic has never been counted (Q17)."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    c = F.col
    orders, lines, pages = read("orders"), read("lineitem"), read("pages")
    out = {
        "yaf_Topic": orders.select(
            (c("o_orderkey") + 1).alias("TopicID"), (c("o_custkey") + OLD_FORUMS).alias("ForumID"),
            (c("o_custkey") + 1_000_000_000).alias("UserID"), c("o_orderdate").alias("Posted"),
            c("o_orderpriority").alias("Topic"), F.when(c("o_custkey") % 3 == 0, 0).otherwise(7).alias("NumPosts"),
            F.lit(0).alias("Flags"), F.lit(0).alias("LastMessageFlags")),
        "yaf_Message": lines.select(
            (c("l_orderkey") * 100 + c("l_linenumber")).alias("MessageID"), (c("l_orderkey") + 1).alias("TopicID"),
            (c("l_linenumber") - 1).alias("Position"), F.lit(0).alias("Indent"), c("l_shipdate").alias("Posted"),
            c("l_returnflag").alias("Message"), F.lit(0).alias("Flags")),
        "yaf_Attachment": pages.select(
            (c("page_id") + 1).alias("AttachmentID"), (c("page_id") * 100 + 1).alias("MessageID"), c("url").alias("FileName"),
            F.octet_length("html").alias("Bytes"), F.lit("text/html").alias("ContentType"), F.lit(1).alias("Downloads"))}
    return {name: conform(df, TARGETS[name], fill=True) for name, df in out.items()}


def early_sources(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The sources as they were when the older half of the conversations had two turns each."""
    half = src["af_content"].agg((F.max("ContentID") / 2).alias("n")).scalar()
    written = src["af_content"].filter((F.col("ContentID") % 100 < 2) & (F.col("ContentID") < half))
    return {**src, "af_content": written}
