"""User flows: guest clone, users, profiles, memberships, flag raises, ASP.NET links
(F15-F24)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import to_date_strict, to_smallint
from ..functions.temporal import shift_minutes, ts_literal
from ..functions.text import name_key
from ..operators.eav import pivot_properties
from ..operators.joins import product_join
from ..operators.merge import update_only_merge
from .board import clone_template
from .migration import Migration

c = F.col
# T-SQL stores the int 0 given for a datetime column as 1900-01-01 (yaf_User.Suspended).
TSQL_ZERO_DATETIME = dt.datetime(1900, 1, 1)
DEFAULT_BIRTHDAY = "1903-01-01T00:00:00"


def _shift(m: Migration, col):
    return shift_minutes(col, m.p.tz_offset_min, m.p.source_tz)


def _name_join(left: DataFrame, right: DataFrame, lcol: str, rcol: str, collation: str | None, how: str = "inner"):
    # merged: a broadcast by text takes a whole memory page in the driver, however few its rows
    return left.join(right.hint("merge"), name_key(left[lcol], collation) == name_key(right[rcol], collation), how)


def _product(m: Migration, big: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    return product_join(big, small, on)


def build_user_map(m: Migration) -> DataFrame:
    """Portal user id -> (id, display name) of the same-named user of the new board: one table
    that every content flow reuses.  Portal user ids are unique, so looking a user up here is the
    same as matching names again."""
    users = m.src["users"].select("UserID", "UserName")
    y = m.board_rows("yaf_User").select(c("UserID").alias("YUserID"), c("Name").alias("YName"),
                                        c("DisplayName").alias("YDisplayName"))
    return _name_join(users, y, "UserName", "YName", m.p.name_collation).select("UserID", "YUserID", "YDisplayName")


def _is_guest(m: Migration):
    """Whether a user's name is the guest's, under the run's name collation (NULL for no name)."""
    return name_key("Name", m.p.name_collation) == F.lit("Guest")


# ------------------------------------------------------------------------- F15
def clone_guest(m: Migration) -> None:
    """All columns copied, RankID included (it keeps the template board's rank, Q24)."""
    clone_template(m, "yaf_User", "UserID", ["BoardID", "Name"], where=_is_guest(m))


# ------------------------------------------------------------------------- F16
def create_users(m: Migration) -> None:
    src, s = m.src, m.scalars
    users = src["users"]
    asp = src["aspnet_users"].select(c("UserId").alias("UserKey"), c("UserName").alias("AUserName"))
    prof = (src["af_user_profiles"].filter(c("PortalID") == F.lit(s["portal_id"]))
            .select(c("UserID").alias("PUserID"), "Signature", "Avatar",
                    (c("TopicCount") + c("ReplyCount")).alias("NumPosts")))
    tz_pid = s.get("tz_pid")
    tz = (src["user_profile"].filter(c("PropertyDefinitionID") == F.lit(tz_pid).cast("bigint"))
          .select(c("UserID").alias("TUserID"), "PropertyValue"))
    x = (_name_join(users, asp, "UserName", "AUserName", m.p.name_collation)
         .join(prof, c("UserID") == c("PUserID"))
         .join(tz, c("UserID") == c("TUserID"), "left"))
    if m.p.require_posts:  # Q6 option: "who ever created a post"
        x = x.filter(c("NumPosts") > 0)
    default_tz = F.lit(s.get("default_tz")).cast("smallint")
    run_ts = ts_literal(m.p.run_ts)
    rows = x.select(
        F.lit(m.board_id).cast("bigint").alias("BoardID"), c("UserKey").alias("ProviderUserKey"),
        c("UserName").alias("Name"), "DisplayName", F.lit("na").alias("Password"), "Email",
        run_ts.alias("Joined"), run_ts.alias("LastVisit"), c("NumPosts").cast("int").alias("NumPosts"),
        F.coalesce(to_smallint(c("PropertyValue"), m.p.tolerant_casts), default_tz).cast("int").alias("TimeZone"),
        "Avatar", "Signature", F.lit(m.new_rank).cast("bigint").alias("RankID"),
        ts_literal(TSQL_ZERO_DATETIME).alias("Suspended"), F.lit(0).alias("SuspendedBy"),
        F.lit(1).alias("OverrideDefaultThemes"), F.lit(1).alias("PMNotification"), F.lit(0).alias("AutoWatchTopics"),
        F.lit(0).alias("DailyDigest"), F.lit(0).alias("NotificationType"), F.lit(2).alias("Flags"),
        F.lit(0).alias("Points"), F.lit(0).alias("IsFacebookUser"), F.lit(0).alias("IsTwitterUser"),
        F.lit(0).alias("StyleFlags"), F.lit(0).alias("IsGoogleUser"), c("UserID").alias("_src_id"))
    m.merge("yaf_User", rows, ["BoardID", "Name"], scope=c("BoardID") == F.lit(m.board_id), id_col="UserID",
            id_order=["Name", "_src_id"])


# ------------------------------------------------------------------------- F17
def user_profiles(m: Migration) -> None:
    """One scan of the EAV table turned into five columns (A5).  A user who holds a property
    twice gets a row per combination, as joining the table once per property would give.
    City comes from the City property (Q1)."""
    src, s = m.src, m.scalars
    y = m.board_rows("yaf_User").select(c("UserID").alias("YUserID"), c("Name").alias("YName"))
    u = src["users"].select("UserID", "UserName", "DisplayName", "LastModifiedOnDate")
    prof = (src["af_user_profiles"].filter(c("PortalID") == F.lit(s["portal_id"]))
            .select(c("UserID").alias("PUserID"), "DateLastActivity"))
    eav = pivot_properties(src["user_profile"], "UserID", "PropertyDefinitionID", {
        "BD": (s.get("bd_pid"), "PropertyValue"),
        "CN": (s.get("cn_pid"), "PropertyText"),
        "RG": (s.get("rg_pid"), "PropertyText"),
        "CY": (s.get("cy_pid"), "PropertyValue"),
        "WS": (s.get("ws_pid"), "PropertyValue"),
    }).withColumnRenamed("UserID", "EUserID")
    x = (_name_join(y, u, "YName", "UserName", m.p.name_collation)
         .join(prof, c("UserID") == c("PUserID"))
         .join(eav, c("UserID") == c("EUserID"), "left"))
    rows = x.select(
        c("YUserID").alias("UserID"), _shift(m, c("LastModifiedOnDate")).alias("LastUpdatedDate"),
        _shift(m, c("DateLastActivity")).alias("LastActivity"),
        F.lit(m.p.profile_application_name).alias("ApplicationName"), F.lit(0).alias("IsAnonymous"),
        c("UserName").alias("UserName"), F.lit(0).alias("Gender"), F.lit("").alias("Blog"),
        c("DisplayName").alias("RealName"), F.lit("").alias("Interests"), F.lit("").alias("Skype"),
        F.lit("").alias("Facebook"), F.lit("").alias("Location"), F.lit("").alias("BlogServiceUrl"),
        to_date_strict(F.coalesce(c("BD"), F.lit(DEFAULT_BIRTHDAY)), m.p.tolerant_casts).alias("Birthday"),
        F.lit("").alias("ICQ"), c("CY").alias("City"), F.lit("").alias("MSN"), F.lit("").alias("Twitter"),
        F.lit("").alias("BlogServicePassword"), c("CN").alias("Country"), F.lit("").alias("Occupation"),
        c("RG").alias("Region"), F.lit("").alias("AIM"), F.lit("").alias("XMPP"), F.lit("").alias("YIM"),
        F.lit("").alias("Google"), F.lit("").alias("BlogServiceUsername"), c("WS").alias("Homepage"))
    m.merge("yaf_UserProfile", rows, ["UserID"])


# ------------------------------------------------------------------- F18-F21
def _board_groups(m: Migration, flags: int) -> DataFrame:
    return m.board_rows("yaf_Group").filter(c("Flags") == F.lit(flags)).select("BoardID", "GroupID")


def _membership(m: Migration, pairs: DataFrame) -> None:
    m.merge("yaf_UserGroup", pairs.select("UserID", "GroupID"), ["UserID", "GroupID"])


def guest_membership(m: Migration) -> None:
    """Guest user x groups with Flags = 2 of the board (joined only through BoardID: J8)."""
    guests = m.board_rows("yaf_User").filter(_is_guest(m)).select("BoardID", "UserID")
    _membership(m, _product(m, guests, _board_groups(m, 2), ["BoardID"]))


def registered_membership(m: Migration) -> None:
    """Every non-guest user of the board x groups with Flags = 4 (NULL names excluded, as
    ``!=`` rejects NULL)."""
    users = m.board_rows("yaf_User").filter(~_is_guest(m)).select("BoardID", "UserID")
    _membership(m, _product(m, users, _board_groups(m, 4), ["BoardID"]))


def superuser_membership(m: Migration) -> None:
    supers = m.src["users"].filter(c("IsSuperUser") == F.lit(1)).select(c("UserName").alias("SName"))
    y = m.board_rows("yaf_User").select("BoardID", "UserID", "Name")
    users = _name_join(y, supers, "Name", "SName", m.p.name_collation).select("BoardID", "UserID")
    _membership(m, _product(m, users, _board_groups(m, 1), ["BoardID"]))


def role_memberships(m: Migration) -> None:
    """UserRoles -> portal roles -> board groups of the same name -> board users.  The
    role->group pairs are tiny, so they are joined first and broadcast (checked) to the
    big UserRoles table, whose RoleID is heavily skewed (a role most users hold)."""
    roles = (m.src["roles"].filter(c("PortalID") == F.lit(m.scalars["portal_id"]))
             .select("RoleID", c("RoleName")))
    groups = m.board_rows("yaf_Group").select("GroupID", c("Name").alias("GName"))
    role_groups = _name_join(roles, groups, "RoleName", "GName", m.p.name_collation).select("RoleID", "GroupID")
    held = _product(m, m.src["user_roles"].select("UserID", "RoleID"), role_groups, ["RoleID"])
    pairs = held.join(m.user_map(), "UserID").select(c("YUserID").alias("UserID"), "GroupID")
    _membership(m, pairs)


# ------------------------------------------------------------------- F22-F23
def _admin_members(m: Migration) -> DataFrame:
    ug = m.tgt["yaf_UserGroup"].select("UserID", "GroupID")
    return _product(m, ug, _board_groups(m, 1).select("GroupID"), ["GroupID"])


def raise_admin_flags(m: Migration) -> None:
    """D3: members of the board's Flags=1 groups get Flags = 98 unless already 98."""
    _raise_flags(m, _admin_members(m).select("UserID"), 98)


def _raise_flags(m: Migration, keys: DataFrame, flags: int) -> None:
    """The keys are members of the board's groups: users this run inserted, and in a resumed run
    earlier ones, whose changed rows become an overlay."""
    unlike = c("Flags") != F.lit(flags)
    m.update("yaf_User", lambda t: update_only_merge(t, keys, ["UserID"], {"Flags": F.lit(flags)}, when=unlike))
    if m.resumed:
        old = m.tgt.before_parts("yaf_User").filter(unlike).join(keys, "UserID", "left_semi")
        m.overlay("yaf_User", "UserID", old.withColumn("Flags", F.lit(flags)))


def raise_superuser_flags(m: Migration) -> None:
    """D3 after F22 (Q18): those of them who are portal super users get 99."""
    y = m.tgt["yaf_User"].select(c("UserID").alias("YUserID"), c("Name").alias("YName"))
    supers = m.src["users"].filter(c("IsSuperUser") == F.lit(1)).select(c("UserName").alias("SName"))
    admins = _admin_members(m).join(y, c("UserID") == c("YUserID"))
    keys = _name_join(admins, supers, "YName", "SName", m.p.name_collation).select("UserID")
    _raise_flags(m, keys, 99)


# ------------------------------------------------------------------------- F24
def aspnet_user_roles(m: Migration) -> None:
    """Membership -> group of the board -> ASP.NET role of the same name (any application,
    literal) -> the user's provider key."""
    groups = m.board_rows("yaf_Group").select("GroupID", c("Name").alias("GName"))
    roles = m.tgt["aspnet_Roles"].select(c("RoleID"), c("RoleName"))
    group_roles = _name_join(groups, roles, "GName", "RoleName", m.p.name_collation).select("GroupID", "RoleID")
    ug = _product(m, m.tgt["yaf_UserGroup"].select("UserID", "GroupID"), group_roles, ["GroupID"])
    users = m.tgt["yaf_User"].filter(c("ProviderUserKey").isNotNull()).select(
        c("UserID").alias("YUserID"), "ProviderUserKey")
    pairs = ug.join(users, c("UserID") == c("YUserID")).select(c("ProviderUserKey").alias("UserID"), "RoleID")
    m.merge("aspnet_UsersInRoles", pairs, ["UserID", "RoleID"])
