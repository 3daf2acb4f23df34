"""Plan checks: the feature table has no cartesian product or nested-loop join and no window
over raw rows, and split filters reach the Parquet scan."""

import re

from conftest import SF001
from txengine.plans import features, split
from txengine.plans.catalog_queries import FIXTURE_SPLIT_START, fixture_features
from txengine.sources.transactions import events_transactions


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_table_has_no_cross_join(spark):
    plan = _plan(features.feature_table(events_transactions(spark, SF001)))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def _windows(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]


def test_no_window_over_raw_rows(spark):
    """Every window partitions rows that were added up before: none carries a row's own id."""
    plan = _plan(features.feature_table(events_transactions(spark, SF001)))
    assert _windows(plan)
    assert not any("transaction_id" in line for line in _windows(plan))


def test_fact_is_read_for_bounds_totals_and_rows_only(spark):
    """The final plan scans the fact for the rows and for the first day; the totals, read
    once, are a written table by then."""
    plan = _plan(features.feature_table(events_transactions(spark, SF001)))
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    fact = [x for x in scans if "events.parquet" in x]
    assert len([x for x in fact if "event_type" in x]) == 1  # the rows
    assert all("FileScan parquet [ts#" in x for x in fact if "event_type" not in x)  # the first day
    assert any("events.parquet" not in x for x in scans)


def test_terminal_side_is_broadcast_when_small(spark):
    plan = _plan(features.feature_table(events_transactions(spark, SF001)))
    assert "BroadcastHashJoin" in plan


def test_terminal_side_shuffles_when_large(spark):
    df = features.feature_table(events_transactions(spark, SF001))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_split_filters_are_pushed(spark):
    feats = fixture_features(spark, SF001)
    train = split.train_split(feats, split.SplitOptions(start=FIXTURE_SPLIT_START, sort=False))
    plan = _plan(train)
    assert "PushedFilters: [IsNotNull(tx_datetime), GreaterThanOrEqual(tx_datetime" in plan


def test_calendar_grid_is_not_a_join(spark):
    from txengine.plans import calendar

    plan = _plan(calendar.customer_day_grid(events_transactions(spark, SF001)))
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert "Generate explode" in plan


def test_grids_look_nothing_up_in_maps(spark):
    from txengine.plans import calendar

    plan = _plan(calendar.customer_daily(events_transactions(spark, SF001)))
    assert "element_at" not in plan and "map_from_entries" not in plan
