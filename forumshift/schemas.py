"""Fixed schemas of the source tables (S01-S24) and target tables.

Schemas are never inferred: every read uses these, so a renamed or retyped column fails
at read time instead of somewhere inside a flow.  Ids are ``bigint`` (an ``int`` overflows
under ANSI mode at scale), 0/1 bits are ``int``, datetimes are ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
}


def struct(columns: str) -> T.StructType:
    """``"A bigint, B string"`` -> StructType (all fields nullable, like the SQL tables)."""
    fields = []
    for item in columns.split(","):
        name, typ = item.split()
        fields.append(T.StructField(name, _TYPES[typ], True))
    return T.StructType(fields)


# --------------------------------------------------------------------------- sources
SOURCES: dict[str, T.StructType] = {
    "modules": struct("ModuleID bigint, PortalID bigint"),
    "tab_modules": struct("TabModuleID bigint, ModuleID bigint, TabID bigint, ModuleTitle string"),
    "tabs": struct("TabID bigint, PortalID bigint, TabPath string"),
    "module_settings": struct("ModuleID bigint, SettingName string, SettingValue string"),
    "portals": struct("PortalID bigint, TimezoneOffset smallint"),
    "roles": struct("RoleID bigint, RoleName string, PortalID bigint"),
    "module_permission": struct("ModuleID bigint, RoleID bigint"),
    "users": struct(
        "UserID bigint, UserName string, DisplayName string, Email string, IsSuperUser int, "
        "LastModifiedOnDate timestamp_ntz"
    ),
    "user_profile": struct(
        "UserID bigint, PropertyDefinitionID bigint, PropertyValue string, PropertyText string"
    ),
    "user_roles": struct("UserID bigint, RoleID bigint"),
    "profile_property_definition": struct(
        "PropertyDefinitionID bigint, PortalID bigint, DataType bigint, PropertyName string"
    ),
    "lists": struct("EntryID bigint, ListName string, Value string"),
    "aspnet_applications": struct("ApplicationID string, ApplicationName string"),
    "aspnet_users": struct("UserId string, UserName string"),
    "af_groups": struct("ForumGroupID bigint, ModuleID bigint, GroupName string, SortOrder int"),
    "af_forums": struct(
        "ForumID bigint, ForumGroupID bigint, ParentForumID bigint, ForumName string, "
        "ForumDesc string, LastPostDate timestamp_ntz, TotalTopics int, TotalReplies int, SortOrder int"
    ),
    "af_topics": struct(
        "TopicID bigint, ContentID bigint, StatusID int, IsDeleted int, IsLocked int, "
        "IsAnnounce int, IsPinned int, IsApproved int, ViewCount int"
    ),
    "af_forum_topics": struct(
        "ForumID bigint, TopicID bigint, LastReplyID bigint, LastTopicDate bigint, LastReplyDate bigint"
    ),
    "af_content": struct(
        "ContentID bigint, AuthorID bigint, Subject string, Summary string, Body string, "
        "DateCreated timestamp_ntz, IPAddress string, IsDeleted int"
    ),
    "af_replies": struct("ReplyID bigint, TopicID bigint, ContentID bigint, IsDeleted int, IsApproved int"),
    "af_attachments": struct(
        "ContentID bigint, UserID bigint, Filename string, FileData binary, ContentType string, "
        "FileSize bigint"
    ),
    "af_forums_tracking": struct("ForumID bigint, UserID bigint, LastAccessDate timestamp_ntz"),
    "af_topics_tracking": struct("TopicID bigint, UserID bigint, DateAdded timestamp_ntz"),
    "af_user_profiles": struct(
        "UserID bigint, PortalID bigint, Signature string, Avatar string, TopicCount int, "
        "ReplyCount int, DateLastActivity timestamp_ntz"
    ),
}

# --------------------------------------------------------------------------- targets
_GROUP_LIKE = (
    "PMLimit int, Style string, SortOrder int, Description string, UsrSigChars int, "
    "UsrSigBBCodes string, UsrSigHTMLTags string, UsrAlbums int, UsrAlbumImages int"
)

TARGETS: dict[str, T.StructType] = {
    "yaf_Board": struct(
        "BoardID bigint, Name string, AllowThreaded int, MembershipAppName string, RolesAppName string"
    ),
    "yaf_AccessMask": struct("AccessMaskID bigint, BoardID bigint, Name string, Flags int, SortOrder int"),
    "yaf_Group": struct(f"GroupID bigint, BoardID bigint, Name string, Flags int, {_GROUP_LIKE}"),
    "yaf_Rank": struct(
        f"RankID bigint, BoardID bigint, Name string, MinPosts int, RankImage string, Flags int, {_GROUP_LIKE}"
    ),
    "yaf_Smiley": struct(
        "SmileyID bigint, BoardID bigint, Code string, Icon string, Emoticon string, SortOrder int"
    ),
    "yaf_Spam_Words": struct("ID bigint, BoardID bigint, SpamWord string"),
    "yaf_Replace_Words": struct("ID bigint, BoardID bigint, BadWord string, GoodWord string"),
    "yaf_Extension": struct("ExtensionID bigint, BoardID bigint, Extension string"),
    "yaf_BBCode": struct(
        "BBCodeID bigint, BoardID bigint, Name string, Description string, OnClickJS string, "
        "DisplayJS string, EditJS string, DisplayCSS string, SearchRegex string, ReplaceRegex string, "
        "Variables string, UseModule int, ModuleClass string, ExecOrder int"
    ),
    "yaf_TopicStatus": struct(
        "TopicStatusID bigint, BoardID bigint, TopicStatusName string, DefaultDescription string"
    ),
    "yaf_Registry": struct("RegistryID bigint, BoardID bigint, Name string, Value string"),
    "aspnet_Roles": struct(
        "ApplicationID string, RoleID string, RoleName string, LoweredRoleName string, Description string"
    ),
    "yaf_User": struct(
        "UserID bigint, BoardID bigint, ProviderUserKey string, Name string, DisplayName string, "
        "Password string, Email string, Joined timestamp_ntz, LastVisit timestamp_ntz, IP string, "
        "NumPosts int, TimeZone int, Avatar string, Signature string, AvatarImage binary, "
        "AvatarImageType string, RankID bigint, Suspended timestamp_ntz, SuspendedReason string, "
        "SuspendedBy int, LanguageFile string, ThemeFile string, TextEditor string, "
        "OverrideDefaultThemes int, PMNotification int, AutoWatchTopics int, DailyDigest int, "
        "NotificationType int, Flags int, Points int, Culture string, IsFacebookUser int, "
        "IsTwitterUser int, UserStyle string, StyleFlags int, IsGoogleUser int"
    ),
    "yaf_UserProfile": struct(
        "UserID bigint, LastUpdatedDate timestamp_ntz, LastActivity timestamp_ntz, ApplicationName string, "
        "IsAnonymous int, UserName string, Gender int, Blog string, RealName string, Interests string, "
        "Skype string, Facebook string, Location string, BlogServiceUrl string, Birthday date, "
        "LastSyncedWithDNN timestamp_ntz, ICQ string, City string, MSN string, TwitterId string, "
        "Twitter string, BlogServicePassword string, Country string, Occupation string, Region string, "
        "AIM string, XMPP string, YIM string, Google string, BlogServiceUsername string, "
        "GoogleId string, Homepage string, FacebookId string"
    ),
    "yaf_UserGroup": struct("UserID bigint, GroupID bigint"),
    "aspnet_UsersInRoles": struct("UserID string, RoleID string"),
    "yaf_Category": struct(
        "CategoryID bigint, BoardID bigint, Name string, CategoryImage string, SortOrder int, "
        "PollGroupID bigint"
    ),
    "yaf_Forum": struct(
        "ForumID bigint, CategoryID bigint, ParentID bigint, Name string, Description string, "
        "SortOrder int, LastPosted timestamp_ntz, LastTopicID bigint, LastMessageID bigint, "
        "LastUserID bigint, LastUserName string, LastUserDisplayName string, NumTopics int, "
        "NumPosts int, RemoteURL string, Flags int, ThemeURL string, PollGroupID bigint, "
        "ImageURL string, Styles string, IsModeratedNewTopicOnly int"
    ),
    "yaf_Topic": struct(
        "TopicID bigint, ForumID bigint, UserID bigint, UserName string, UserDisplayName string, "
        "Posted timestamp_ntz, Topic string, Description string, Status string, Styles string, "
        "LinkDate timestamp_ntz, Views int, Priority int, PollID bigint, TopicMovedID bigint, "
        "LastPosted timestamp_ntz, LastMessageID bigint, LastUserID bigint, LastUserName string, "
        "LastUserDisplayName string, NumPosts int, Flags int, AnswerMessageId bigint, "
        "LastMessageFlags int, TopicImage string"
    ),
    "yaf_Message": struct(
        "MessageID bigint, TopicID bigint, ReplyTo bigint, Position int, Indent int, UserID bigint, "
        "UserName string, UserDisplayName string, Posted timestamp_ntz, Message string, IP string, "
        "Edited timestamp_ntz, Flags int, EditReason string, IsModeratorChanged int, "
        "DeleteReason string, ExternalMessageId string, ReferenceMessageId bigint, BlogPostID string, "
        "EditedBy bigint"
    ),
    "yaf_Attachment": struct(
        "AttachmentID bigint, MessageID bigint, UserID bigint, FileName string, Bytes bigint, "
        "ContentType string, Downloads int, FileData binary"
    ),
    "yaf_WatchForum": struct(
        "WatchForumID bigint, ForumID bigint, UserID bigint, Created timestamp_ntz, LastMail timestamp_ntz"
    ),
    "yaf_WatchTopic": struct(
        "WatchTopicID bigint, TopicID bigint, UserID bigint, Created timestamp_ntz, LastMail timestamp_ntz"
    ),
    "yaf_ForumAccess": struct("GroupID bigint, ForumID bigint, AccessMaskID bigint"),
}

# Surrogate key column of each target (assigned by D6); tables without one are keyed by
# their natural columns only.
ID_COLUMNS: dict[str, str] = {
    "yaf_Board": "BoardID",
    "yaf_AccessMask": "AccessMaskID",
    "yaf_Group": "GroupID",
    "yaf_Rank": "RankID",
    "yaf_Smiley": "SmileyID",
    "yaf_Spam_Words": "ID",
    "yaf_Replace_Words": "ID",
    "yaf_Extension": "ExtensionID",
    "yaf_BBCode": "BBCodeID",
    "yaf_TopicStatus": "TopicStatusID",
    "yaf_Registry": "RegistryID",
    "yaf_User": "UserID",
    "yaf_Category": "CategoryID",
    "yaf_Forum": "ForumID",
    "yaf_Topic": "TopicID",
    "yaf_Message": "MessageID",
    "yaf_Attachment": "AttachmentID",
    "yaf_WatchForum": "WatchForumID",
    "yaf_WatchTopic": "WatchTopicID",
}

# Lineage columns (F37/F38): source id of a migrated row, present only while a run works.
LINEAGE: dict[str, str] = {
    "yaf_Board": "oModuleID",
    "yaf_Category": "oGroupID",
    "yaf_Forum": "oForumID",
    "yaf_Topic": "oTopicID",
    "yaf_Message": "oContentID",
}


def target_schema(name: str, with_lineage: bool = False) -> T.StructType:
    schema = TARGETS[name]
    if with_lineage and name in LINEAGE:
        schema = T.StructType(schema.fields + [T.StructField(LINEAGE[name], T.LongType(), True)])
    return schema


class MissingColumns(ValueError):
    pass


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, Column] | None = None,
            fill: bool = False, name: str = "table") -> DataFrame:
    """Project ``df`` onto ``schema``: same order, cast types.  A column that ``df`` lacks raises,
    unless ``defaults`` has an expression for it or ``fill`` asks for typed NULLs.  Columns of
    ``df`` outside the schema are dropped.
    """
    defaults = defaults or {}
    names = {c.lower() for c in df.columns}
    absent = [f.name for f in schema.fields if f.name.lower() not in names and f.name not in defaults]
    if absent and not fill:
        raise MissingColumns(f"{name} lacks the columns {absent}")
    present = {c.lower(): c for c in df.columns}
    out = []
    for field in schema.fields:
        src = present.get(field.name.lower())
        if src is not None:
            expr = F.col(src)
        elif field.name in defaults:
            expr = defaults[field.name]
        else:
            expr = F.lit(None)
        out.append(expr.cast(field.dataType).alias(field.name))
    return df.select(*out)


def empty(spark, schema: T.StructType) -> DataFrame:
    """An empty table with real statistics (zero rows), so joins against it can broadcast."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
