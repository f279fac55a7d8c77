"""list the forum modules that can be migrated, with the pages they sit on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import name_key


def discover_boards(src: dict[str, DataFrame], name_collation: str | None = None) -> DataFrame:
    """Groups JOIN TabModules JOIN Tabs LEFT JOIN ModuleSettings(SettingName='MODE'), DISTINCT.

    The constant of the outer join's ON clause filters the settings *before* the join (a
    WHERE after it would turn the outer join into an inner one).  All modes are returned;
    only 'Standard' modules can be migrated (Q20), the caller filters ``ForumMode``.

    The result is distinct, so each side is made distinct before the joins: a module's groups,
    placements and settings are not multiplied by each other's repetitions.
    """
    g = src["af_groups"].select("ModuleID").distinct()
    m = src["tab_modules"].select("ModuleID", "TabID", "ModuleTitle").distinct()
    t = src["tabs"].select("TabID", "PortalID", "TabPath").distinct()
    s = (src["module_settings"].filter(name_key("SettingName", name_collation) == F.lit("MODE"))
         .select(F.col("ModuleID").alias("S_ModuleID"), "SettingValue").distinct())
    joined = (g.join(m, "ModuleID").join(t, "TabID")
               .join(s, F.col("ModuleID") == F.col("S_ModuleID"), "left"))
    return joined.select(
        F.col("ModuleID").alias("ModuleId"), "PortalID", F.col("TabPath").alias("PagePath"), "ModuleTitle",
        F.col("SettingValue").alias("ForumMode")).distinct()
