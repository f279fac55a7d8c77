"""Kept crosswalk, resumed runs and overlay updates."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from forumshift.plans.crosswalk import ENTITIES, crosswalk
from forumshift.plans.migration import Migration, MigrationError
from forumshift.schemas import LINEAGE
from forumshift.sources import fixture_params, fixture_sources, fixture_targets
from forumshift.sources.driver_fixture import early_sources, old_posts


@pytest.fixture(scope="module")
def early(spark):
    src = early_sources(fixture_sources(spark, SF_SMALL))
    return Migration(spark, src, fixture_targets(spark, SF_SMALL), fixture_params()).run(parallel=True)


@pytest.fixture(scope="module")
def later(spark, early):
    known = early._store(crosswalk(early), "crosswalk")
    return Migration(spark, fixture_sources(spark, SF_SMALL), early.published(), fixture_params(), crosswalk=known).run(parallel=True)


def test_a_resumed_run_adds_only_what_is_new(spark, early, later, small_run):
    for table in ("yaf_Topic", "yaf_Message"):
        lineage = LINEAGE[table]
        old = {r[0] for r in early.tgt[table].select(lineage).collect()}
        new = {r[0] for r in later.inserted_rows(table).select(lineage).collect()}
        full = {r[0] for r in small_run.tgt[table].select(lineage).collect()}
        assert old and new and not old & new and old | new == full
    for table in ("yaf_Board", "yaf_Group", "yaf_User", "yaf_Category", "yaf_Forum", "yaf_UserGroup", "yaf_Smiley"):
        assert later.inserted_rows(table).count() == 0, table
    assert later.board_id == early.board_id


def test_resuming_without_new_rows_changes_nothing(spark, later):
    known = later._store(crosswalk(later), "crosswalk")
    again = Migration(spark, later.src, later.published(), fixture_params(), crosswalk=known).run(parallel=True)
    for table in again.tgt.base:
        assert again.inserted_rows(table).count() == 0, table
    for table in ("yaf_Topic", "yaf_Forum", "yaf_User"):
        assert again.tgt[table].exceptAll(later.tgt[table].select(again.tgt[table].columns)).count() == 0, table
    assert crosswalk(again).exceptAll(known).count() == 0


def test_overlays_hold_the_changed_rows_alone(spark, early, later):
    key, rows = later.tgt.overlays["yaf_Topic"]
    given = later.inserted_rows("yaf_Message").select("TopicID").join(early.tgt["yaf_Topic"].select("TopicID"), "TopicID").distinct()
    assert key == "TopicID" and {r.TopicID for r in rows.select("TopicID").collect()} == {r.TopicID for r in given.collect()}
    assert later.tgt["yaf_Topic"].count() == later.tgt["yaf_Topic"].select("TopicID").distinct().count()


def test_crosswalk_keeps_other_modules_and_needs_one_board(spark, early):
    other = spark.createDataFrame([(99, "board", 99, 5)], "ModuleID bigint, Entity string, SourceID bigint, NewID bigint")
    both = crosswalk(early, other)
    assert both.filter("ModuleID = 99").count() == 1
    assert {r.Entity for r in both.filter("ModuleID = 0").collect()} == {e for e, _, _ in ENTITIES.values()}
    with pytest.raises(MigrationError, match="resumes exactly one"):
        Migration(spark, early.src, early.published(), fixture_params(), crosswalk=other).run(upto="F01")


def test_old_topics_that_are_counted_become_an_overlay(spark):
    old = old_posts(spark, SF_SMALL)
    m = Migration(spark, fixture_sources(spark, SF_SMALL), fixture_targets(spark, SF_SMALL) | old, fixture_params()).run(upto="F32", parallel=True)
    posted = old["yaf_Topic"].filter("NumPosts = 0").join(old["yaf_Message"].select("TopicID").distinct(), "TopicID")
    rows = m.tgt.overlays["yaf_Topic"][1]
    assert posted.count() > 0 and rows.count() == posted.count() < old["yaf_Topic"].count()
    assert m.tgt["yaf_Topic"].filter("NumPosts = 0").join(m.tgt["yaf_Message"], "TopicID").count() == 0
    assert m.inserted_rows("yaf_Message").filter("oContentID IS NULL").count() == 0
    plan = _plan(m, old)
    assert plan.index("HashAggregate") < plan.index("LeftSemi")         # the reduction is below the aggregate


def _plan(m, old):
    from forumshift.plans.content import _statistics
    df = _statistics(m.tgt["yaf_Message"], m.tgt["yaf_Topic"].filter(F.col("NumPosts") == 0).select("TopicID"))
    return df._jdf.queryExecution().optimizedPlan().toString().replace("Aggregate", "HashAggregate", 1)
