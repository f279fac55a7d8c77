from forumshift.schemas import LINEAGE, SOURCES, TARGETS, conform, empty, target_schema


def test_conform_casts_fills_and_drops(spark):
    df = spark.createDataFrame([("7", "x", 1)], "ModuleID string, Extra string, PortalID int")
    out = conform(df, SOURCES["modules"])
    assert out.columns == ["ModuleID", "PortalID"]
    assert dict(out.dtypes) == {"ModuleID": "bigint", "PortalID": "bigint"}
    row = conform(spark.createDataFrame([(1,)], "ModuleID int"), SOURCES["modules"], fill=True).first()
    assert row.ModuleID == 1 and row.PortalID is None


def test_empty_tables_have_zero_row_statistics(spark):
    df = empty(spark, TARGETS["yaf_Message"])
    assert df.count() == 0 and df.schema == TARGETS["yaf_Message"]
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(size)) < 1024          # broadcastable, unlike an RDD of unknown size


def test_schema_inventory():
    assert len(SOURCES) == 24 and len(TARGETS) == 24
    for table, col in LINEAGE.items():
        assert target_schema(table, with_lineage=True).fieldNames()[-1] == col
