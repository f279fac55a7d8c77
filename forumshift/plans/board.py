"""Board-level flows: run scalars (F01), the board (F02), template clones (F03-F13) and
ASP.NET roles (F14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lowered, name_guid, name_key, random_guid
from ..operators.joins import not_in
from ..operators.lookups import resolve
from ..schemas import ID_COLUMNS
from .migration import Migration, MigrationError


def _col(name: str) -> Column:
    return F.col(name)


# ------------------------------------------------------------------------- F01
def resolve_run_scalars(m: Migration) -> None:
    """The portal, its default zone offset, the application id, the profile property ids and the
    new board's id, in one job.  Nested lookups (portal -> its definitions) stay scalar
    subqueries inside that job.  Fails fast when the module is unknown or already migrated (Q7)."""
    src, p = m.src, m.p
    mod = F.lit(p.module_id).cast("bigint")
    portal_df = src["modules"].filter(_col("ModuleID") == mod).select("PortalID")
    portal = portal_df.scalar()
    defs = src["profile_property_definition"].filter(_col("PortalID") == portal)

    def named(col: str, *names: str) -> Column:                  # Q10: constants compare like names do
        return name_key(col, p.name_collation).isin(*names)

    tz_type = src["lists"].filter(named("ListName", "DataType") & named("Value", "TimeZone")).select("EntryID")

    def prop(name: str) -> DataFrame:
        return defs.filter(named("PropertyName", name)).select("PropertyDefinitionID")

    lookups = {
        "portal_id": portal_df,
        "default_tz": src["portals"].filter(_col("PortalID") == portal).select("TimezoneOffset"),
        "app_guid": src["aspnet_applications"].filter(named("ApplicationName", *p.app_names))
                                              .select("ApplicationID"),
        "tz_pid": defs.filter(_col("DataType") == tz_type.scalar()).select("PropertyDefinitionID"),
        "bd_pid": prop("Birthday"),
        "cn_pid": prop("Country"),
        "rg_pid": prop("Region"),
        "cy_pid": prop("City"),
        "ws_pid": prop("Website"),
        "max_board": m.tgt["yaf_Board"].select(F.max("BoardID")),
        "placements": src["tab_modules"].filter(_col("ModuleID") == mod).select(F.count(F.lit(1))),
        "board": m.tgt["yaf_Board"].filter(_col("oModuleID") == mod).select(F.max("BoardID")),
        "existing": m.tgt["yaf_Board"].filter(_col("oModuleID") == mod).select(F.count(F.lit(1))),
        "template": m.tgt["yaf_Board"].filter(_col("BoardID") == F.lit(p.template_board_id)).select(F.count(F.lit(1))),
    }
    # highest existing id of every target, in the same job (later statements advance them)
    for table, id_col in ID_COLUMNS.items():
        lookups[f"max_id:{table}"] = m.tgt[table].select(F.coalesce(F.max(id_col).cast("bigint"), F.lit(0).cast("bigint")))
    s = resolve(m.spark, lookups)
    for table in ID_COLUMNS:
        m._max_ids.setdefault(table, int(s.pop(f"max_id:{table}")))
    if s["portal_id"] is None:
        raise MigrationError(f"module {p.module_id} not found (set RunParams.module_id)")
    if not s["placements"]:
        raise MigrationError(f"module {p.module_id} is not placed on any page; no board can be created")
    if m.resumed and s["existing"] != 1:
        raise MigrationError(f"the crosswalk has {s['existing']} boards of module {p.module_id}; a run resumes exactly one")
    if not m.resumed and p.fail_if_board_exists and s["existing"]:
        raise MigrationError(f"module {p.module_id} was already migrated (a board has oModuleID={p.module_id})")
    if not s["template"]:
        raise MigrationError(f"template board {p.template_board_id} does not exist")
    m.scalars = s


# ------------------------------------------------------------------------- F02
def create_board(m: Migration) -> None:
    """The module's first placement becomes the board, whatever boards exist: a left semi join
    with the one-row minimum of its placement ids.  A resumed run goes on with the board it has."""
    if m.resumed:
        m.board_id = int(m.scalars["board"])
        return
    tm = m.src["tab_modules"]
    first = (tm.filter(_col("ModuleID") == F.lit(m.p.module_id))
               .agg(F.min("TabModuleID").alias("TabModuleID")))
    rows = tm.join(first, "TabModuleID", "left_semi").select(
        _col("ModuleTitle").alias("Name"), F.lit(1).alias("AllowThreaded"), F.lit("").alias("MembershipAppName"),
        F.lit("").alias("RolesAppName"), _col("ModuleID").alias("oModuleID"), _col("TabModuleID"))
    m.append("yaf_Board", rows, id_col="BoardID", id_order=["TabModuleID"])
    # the only row inserted takes max + 1 (D6); checked against the table in the tests
    m.board_id = int(m.scalars["max_board"] or 0) + 1


# ------------------------------------------------------------------- F03-F13
def clone_template(m: Migration, table: str, id_col: str, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """The template board's rows of a table, given to the new board where it lacks them.

    The source reads the table as it was before the statement (immutable DataFrame).  New
    ids follow the template rows' own ids, so the clone keeps the template's order.
    """
    tpl = m.tgt[table].filter(_col("BoardID") == F.lit(m.p.template_board_id))
    if where is not None:
        tpl = tpl.filter(where)
    src = tpl.withColumn("_tpl_id", _col(id_col)).drop(id_col).withColumn("BoardID", F.lit(m.board_id).cast("bigint"))
    return m.merge(table, src, keys, id_col=id_col, id_order=["_tpl_id"])


def clone_access_masks(m: Migration) -> None:
    clone_template(m, "yaf_AccessMask", "AccessMaskID", ["BoardID", "SortOrder"])


def clone_default_groups(m: Migration) -> None:
    # Flags != 0 also drops NULL flags (NULL comparison is not true)
    clone_template(m, "yaf_Group", "GroupID", ["BoardID", "Name"], where=_col("Flags") != F.lit(0))


def groups_from_roles(m: Migration) -> None:
    """roles with a permission on the module (semi join), minus -- literally, Q2 -- every
    role of the module's portal (``NOT IN`` with its NULL rules, ``joins.not_in``)."""
    src, mod = m.src, F.lit(m.p.module_id)
    roles = src["roles"]
    permitted = src["module_permission"].filter(_col("ModuleID") == mod).select("RoleID")
    cand = roles.join(permitted, "RoleID", "left_semi")
    if m.p.exclude_portal_roles:
        portal_roles = (roles.join(src["portals"].select("PortalID"), "PortalID")
                             .join(src["modules"].filter(_col("ModuleID") == mod).select("PortalID"), "PortalID")
                             .select("RoleID"))
        cand = not_in(cand, "RoleID", portal_roles)
    rows = cand.select(
        F.lit(m.board_id).cast("bigint").alias("BoardID"), _col("RoleName").alias("Name"), F.lit(0).alias("Flags"),
        F.lit(0).alias("PMLimit"), F.lit(None).cast("string").alias("Style"), F.lit(100).alias("SortOrder"),
        F.lit("").alias("Description"), F.lit(0).alias("UsrSigChars"), F.lit("").alias("UsrSigBBCodes"),
        F.lit("").alias("UsrSigHTMLTags"), F.lit(0).alias("UsrAlbums"), F.lit(0).alias("UsrAlbumImages"),
        _col("RoleID").alias("_role_id"))
    m.merge("yaf_Group", rows, ["BoardID", "Name"], scope=_col("BoardID") == F.lit(m.board_id),
            id_col="GroupID", id_order=["Name", "_role_id"])


def clone_ranks(m: Migration) -> None:
    clone_template(m, "yaf_Rank", "RankID", ["BoardID", "Name"])
    rank = m.board_rows("yaf_Rank").filter(_col("MinPosts") == F.lit(0)).select("RankID")
    m.new_rank = resolve(m.spark, {"new_rank": rank})["new_rank"]


def clone_smileys(m: Migration) -> None:
    clone_template(m, "yaf_Smiley", "SmileyID", ["BoardID", "SortOrder"])


def clone_spam_words(m: Migration) -> None:
    clone_template(m, "yaf_Spam_Words", "ID", ["BoardID", "SpamWord"])


def clone_replace_words(m: Migration) -> None:
    clone_template(m, "yaf_Replace_Words", "ID", ["BoardID", "BadWord"])


def clone_extensions(m: Migration) -> None:
    clone_template(m, "yaf_Extension", "ExtensionID", ["BoardID", "Extension"])


def clone_bbcodes(m: Migration) -> None:
    clone_template(m, "yaf_BBCode", "BBCodeID", ["BoardID", "Name"])


def clone_topic_status(m: Migration) -> None:
    clone_template(m, "yaf_TopicStatus", "TopicStatusID", ["BoardID", "TopicStatusName"])


def clone_registry(m: Migration) -> None:
    clone_template(m, "yaf_Registry", "RegistryID", ["BoardID", "Name"])


# ------------------------------------------------------------------------- F14
def aspnet_roles(m: Migration) -> None:
    """One ASP.NET role per group of the board, matched on the role name only (not scoped to
    the application -- literal).  ``NewID()`` becomes a GUID derived from application, group
    name and group id (reproducible under recomputation) unless random ids are asked for."""
    app = F.lit(m.scalars.get("app_guid")).cast("string")
    groups = m.board_rows("yaf_Group")
    role_id = (name_guid(app, _col("Name"), _col("GroupID").cast("string")) if m.p.deterministic_role_ids
               else random_guid())
    rows = groups.select(app.alias("ApplicationID"), role_id.alias("RoleID"), _col("Name").alias("RoleName"),
                         lowered("Name").alias("LoweredRoleName"), F.lit(None).cast("string").alias("Description"))
    m.merge("aspnet_Roles", rows, ["RoleName"])
