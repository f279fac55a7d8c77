"""Categories and the forum tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import shift_minutes
from ..functions.text import left
from ..operators.joins import spread_join
from ..operators.tree import resolve
from .migration import Migration, MigrationError

c = F.col


def categories(m: Migration) -> None:
    """the module's forum groups become categories of the board (lineage oGroupID)."""
    rows = m.src["af_groups"].filter(c("ModuleID") == F.lit(m.p.module_id)).select(
        F.lit(m.board_id).cast("bigint").alias("BoardID"), c("GroupName").alias("Name"),
        F.lit("categoryImageSample.gif").alias("CategoryImage"), "SortOrder",
        F.lit(None).cast("bigint").alias("PollGroupID"), c("ForumGroupID").alias("oGroupID"))
    m.merge("yaf_Category", rows, ["BoardID", "Name"], scope=c("BoardID") == F.lit(m.board_id), id_col="CategoryID",
            id_order=["oGroupID", "Name"])


def _forum_source(m: Migration) -> DataFrame:
    """AF forums joined to the categories created by this run (``F.ForumGroupID = C.oGroupID``;
    categories from earlier runs have no lineage and never match)."""
    cats = m.tgt["yaf_Category"].filter(c("oGroupID").isNotNull()).select("CategoryID", "oGroupID")
    f = m.src["af_forums"]
    return f.join(cats, f.ForumGroupID == cats.oGroupID)


def _forum_rows(m: Migration, df: DataFrame, parent, *more) -> DataFrame:
    return df.select(
        *more,
        "CategoryID", parent.alias("ParentID"), left("ForumName", 50).alias("Name"),
        left("ForumDesc", 255).alias("Description"), "SortOrder",
        shift_minutes("LastPostDate", m.p.tz_offset_min, m.p.source_tz).alias("LastPosted"),
        c("TotalTopics").alias("NumTopics"), (c("TotalTopics") + c("TotalReplies")).alias("NumPosts"),
        F.lit(4).alias("Flags"), F.lit(0).alias("IsModeratedNewTopicOnly"), c("ForumID").alias("oForumID"),
        c("ForumName").alias("_full_name"))


def _children(m: Migration, parents: DataFrame) -> DataFrame:
    """Source forums right below ``parents`` (ForumID, oForumID of migrated forums)."""
    above = parents.select(c("ForumID").alias("PForumID"), c("oForumID").alias("POForumID"))
    src = m.absent(_forum_source(m), "ForumID", "yaf_Forum")
    return _forum_rows(m, src.join(above, src.ParentForumID == above.POForumID), c("PForumID"))


def _merge_by_name(m: Migration, rows: DataFrame) -> DataFrame:
    # Q4: the match uses the untruncated name while the stored name is cut at 50
    return m.merge("yaf_Forum", rows, ["CategoryID", "Name"], source_keys=["CategoryID", "_full_name"],
                   id_col="ForumID", id_order=["oForumID", "CategoryID"])


def parent_forums(m: Migration) -> None:
    """root forums (ParentForumID = 0)."""
    roots = m.absent(_forum_source(m).filter(c("ParentForumID") == F.lit(0)), "ForumID", "yaf_Forum")
    _merge_by_name(m, _forum_rows(m, roots, F.lit(None).cast("bigint")))


def child_forums(m: Migration) -> None:
    """forums whose parent was migrated *before* the statement (one hop, J7).

    The reference runs the hop once and matches names, so deeper forums are not migrated (Q3).
    With ``forum_full_depth`` all levels are migrated at once, matching source ids: no depth and
    no equal name loses a forum."""
    migrated = m.tgt["yaf_Forum"].filter(c("oForumID").isNotNull())
    if m.p.forum_full_depth:
        _descendants(m, migrated)
    else:
        # the statement sees the roots: those of this run, and in a resumed run the earlier ones
        _merge_by_name(m, _children(m, migrated.filter(c("ParentID").isNull())))


def _descendants(m: Migration, migrated: DataFrame) -> None:
    """Every forum below a migrated root.  Levels come from pointer doubling (about log2(depth) rounds),
    so the rows are numbered once, by level and source id, and then find their parents' new ids."""
    src = m._store(_forum_source(m).select("ForumID", "ParentForumID").distinct(), "forum-links")
    tree = resolve(src, "ForumID", "ParentForumID", c("ParentForumID") == F.lit(0), lambda df: m._store(df, "forum-tree"))
    m.tree_rounds = tree.rounds
    cyclic = m._store(tree.cyclic, "forum-cycles")
    some = [r.id for r in cyclic.orderBy("id").limit(10).collect()]
    if some:
        raise MigrationError(f"{cyclic.count()} forums are their own ancestors or below such forums, e.g. {some}")
    ids = migrated.select(c("oForumID").alias("_old"), c("ForumID").alias("_new"))
    below = tree.nodes.filter("level > 0").join(ids, c("root") == c("_old"), "left_semi")
    forums = _forum_source(m).join(below.select(c("id").alias("ForumID"), "level"), "ForumID")
    rows = _forum_rows(m, forums, F.lit(None).cast("bigint"), c("ParentForumID").alias("_above"), "level").drop("ParentID")

    def with_parents(numbered: DataFrame) -> DataFrame:
        every = ids.unionByName(numbered.select(c("oForumID").alias("_old"), c("ForumID").alias("_new")))
        return spread_join(numbered, every.select(c("_old").alias("_above"), c("_new").alias("ParentID")), ["_above"])

    m.merge("yaf_Forum", rows, ["oForumID"], id_col="ForumID", id_order=["level", "oForumID", "CategoryID"],
            attach=with_parents)
