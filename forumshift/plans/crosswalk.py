"""D7 kept beyond a run: which target row came from which source row.

The lineage columns exist only during a run (F37/F38).  ``crosswalk`` turns them into a table of
its own -- (ModuleID, Entity, SourceID, NewID) -- to be kept beside the targets.  A later run of the
same module that is given this table has the lineage of all earlier rows again, so it resumes the
board: only source rows without a crosswalk row are migrated, and what depends on them (counts,
last replies, roll-ups) is brought up to date by overlays of the rows that change.
"""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from .migration import Migration

SCHEMA = "ModuleID bigint, Entity string, SourceID bigint, NewID bigint"
#: table -> (entity, lineage column, id column)
ENTITIES = {
    "yaf_Board": ("board", "oModuleID", "BoardID"),
    "yaf_Category": ("category", "oGroupID", "CategoryID"),
    "yaf_Forum": ("forum", "oForumID", "ForumID"),
    "yaf_Topic": ("topic", "oTopicID", "TopicID"),
    "yaf_Message": ("message", "oContentID", "MessageID"),
}


def crosswalk(m: Migration, earlier: DataFrame | None = None) -> DataFrame:
    """The crosswalk after a run: this module's rows, and other modules' from ``earlier``."""
    parts = [m.tgt[table].filter(F.col(lineage).isNotNull()).select(
        F.lit(m.p.module_id).cast("bigint").alias("ModuleID"), F.lit(entity).alias("Entity"),
        F.col(lineage).alias("SourceID"), F.col(new).alias("NewID")) for table, (entity, lineage, new) in ENTITIES.items()]
    if earlier is not None:
        parts.append(earlier.filter(F.col("ModuleID") != F.lit(m.p.module_id)).select(parts[0].columns))
    return reduce(DataFrame.unionByName, parts)


def with_lineage(df: DataFrame, table: str, known: DataFrame, module_id: int) -> DataFrame:
    """``df`` with the lineage column that ``known`` gives its rows (ids without a row: NULL).  Flows
    that use the column ask for few others, so only these and the id are shuffled."""
    entity, lineage, new = ENTITIES[table]
    own = known.filter((F.col("ModuleID") == F.lit(module_id)) & (F.col("Entity") == F.lit(entity)))
    return df.join(own.select(F.col("NewID").alias(new), F.col("SourceID").alias(lineage)), new, "left").select(*df.columns, lineage)
