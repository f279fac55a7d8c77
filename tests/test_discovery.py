"""F00 on modules with many placements and settings."""

from forumshift.plans.discovery import discover_boards


def test_placements_and_settings_do_not_multiply(spark):
    groups = spark.range(40).selectExpr("id % 2 AS ModuleID").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS ModuleID"))
    placed = spark.range(60).selectExpr("id AS TabModuleID", "id % 2 AS ModuleID", "id % 2 AS TabID", "concat('title ', id % 4) AS ModuleTitle")
    tabs = spark.createDataFrame([(0, 0, "//a"), (1, 0, "//b"), (1, 0, "//b")], "TabID long, PortalID long, TabPath string")
    settings = spark.range(80).selectExpr("0L AS ModuleID", "CASE WHEN id % 2 = 0 THEN 'MODE' ELSE 'X' END AS SettingName",
                                          "CASE WHEN id % 4 = 0 THEN 'Standard' END AS SettingValue")
    df = discover_boards({"af_groups": groups, "tab_modules": placed, "tabs": tabs, "module_settings": settings})
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, [
        (0, 0, "//a", t, mode) for t in ("title 0", "title 2") for mode in ("Standard", None)] + [
        (1, 0, "//b", t, None) for t in ("title 1", "title 3")]))
    aggregates, depth = 0, None
    for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        if "Join " in line and depth is None:
            depth = at
        aggregates += depth is not None and at > depth and "Aggregate [" in line
    assert aggregates >= 4              # groups, placements, tabs and settings are distinct before they meet
