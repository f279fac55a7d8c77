import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from forumshift.__main__ import main
from forumshift.operators.publish import read_published
from forumshift.plans.migration import Migration, MigrationError
from forumshift.schemas import MissingColumns
from forumshift.sources import fixture_params, fixture_sources, fixture_targets
from forumshift.sources.tables import read_sources, read_tables, read_targets


def test_cli_reads_folders_runs_and_publishes(spark):
    root = tempfile.mkdtemp(prefix="forumshift-cli-")
    for name, df in fixture_sources(spark, SF_SMALL).items():
        df.write.parquet(f"{root}/src/{name}")
    for name, df in fixture_targets(spark, SF_SMALL).items():
        df.write.parquet(f"{root}/tgt/{name}")
    assert set(read_sources(spark, f"{root}/src")) >= {"modules", "af_content"}
    run = ["--sources", f"{root}/src", "--targets", f"{root}/tgt", "--out", f"{root}/out", "--module-id", "0",
           "--tz-offset", "-60"]
    part = main([*run, "--upto", "F02"], spark=spark)
    assert part["board_id"] == 6 and part["flows"] == ["F01", "F02"] and "run" not in part
    report = main(run, spark=spark)
    back = read_published(spark, f"{root}/out", report["run"])
    assert back["yaf_Board"].count() == 6 and "oModuleID" not in back["yaf_Board"].columns
    assert back["yaf_Message"].count() > 0
    # only what changed is written; the input folder stays part of the table
    assert report["tables"]["yaf_Board"][0] == f"{root}/tgt/yaf_Board" and len(report["tables"]["yaf_Board"]) == 2


def test_cli_goes_on_from_a_published_run(spark):
    """A second module on the first's result; then the first module again, which finds nothing new."""
    root = tempfile.mkdtemp(prefix="forumshift-cli-")
    for name, df in fixture_sources(spark, SF_SMALL).items():
        df.write.parquet(f"{root}/src/{name}")
    for name, df in fixture_targets(spark, SF_SMALL).items():
        df.write.parquet(f"{root}/tgt/{name}")
    run = ["--sources", f"{root}/src", "--out", f"{root}/out", "--tz-offset", "-60"]
    one = main([*run, "--targets", f"{root}/tgt", "--module-id", "0"], spark=spark)
    two = main([*run, "--targets", f"{root}/out", "--from-run", one["run"], "--module-id", "1"], spark=spark)
    assert (one["board_id"], two["board_id"]) == (6, 7)
    first, second = [read_published(spark, f"{root}/out", x["run"]) for x in (one, two)]
    assert {r.ModuleID for r in second["crosswalk"].select("ModuleID").distinct().collect()} == {0, 1}
    assert second["yaf_Category"].count() == first["yaf_Category"].count() + 1
    again = main([*run, "--targets", f"{root}/out", "--from-run", two["run"], "--module-id", "0"], spark=spark)
    third = read_published(spark, f"{root}/out", again["run"])
    assert again["board_id"] == 6
    for table in second:
        assert third[table].count() == second[table].count(), table


def test_lineage_of_an_earlier_run_is_kept_and_refuses_a_second(spark):
    root = tempfile.mkdtemp(prefix="forumshift-cli-")
    src, tgt = fixture_sources(spark, SF_SMALL), fixture_targets(spark, SF_SMALL)
    boards = tgt["yaf_Board"].withColumn("oModuleID", F.when(F.col("BoardID") == 5, F.lit(0).cast("bigint")))
    for name, df in {**tgt, "yaf_Board": boards}.items():
        df.write.parquet(f"{root}/{name}")
    with pytest.raises(MigrationError, match="already migrated"):
        Migration(spark, src, read_targets(spark, root), fixture_params()).run(upto="F01")


def test_a_missing_column_raises(spark):
    root = tempfile.mkdtemp(prefix="forumshift-cli-")
    df = fixture_sources(spark, SF_SMALL)["af_content"].withColumnRenamed("Body", "Text")
    df.write.parquet(f"{root}/af_content")
    with pytest.raises(MissingColumns, match="Body"):
        read_tables(spark, root, ["af_content"])
