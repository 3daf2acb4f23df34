"""The saved feature table: brought up to date day by day, and bucketed by customer."""

import os
import random
from urllib.parse import urlparse

from pyspark.sql import functions as F

from conftest import SF001
from txengine.plans import features, split
from txengine.plans.catalog_queries import FIXTURE_SPLIT_START, _scratch_table
from txengine.sources.transactions import events_transactions

OPTS = features.FeatureOptions(windows=(1, 2, 4), delay=2)


def _files(spark, table: str) -> dict[str, set]:
    """day -> data files of a saved table."""
    root = _location(spark, table)
    return {
        day: {f for f in os.listdir(f"{root}/{day}") if f.endswith(".parquet")} for day in os.listdir(root) if day.startswith("tx_time_days=")
    }


def _location(spark, table: str) -> str:
    rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    return urlparse(rows["Location"]).path


def _saved(spark, tx, opts):
    table = _scratch_table(spark, "features_test")
    features.save_feature_table(features.feature_table(tx, opts), table)
    return table


def _same(spark, table, tx, opts):
    want = features.feature_table(tx, opts)
    got = spark.table(table).select(*want.columns)
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_new_days_are_added_and_no_other_file_is_touched(spark):
    tx = events_transactions(spark, SF001).where("tx_time_days < 14").cache()
    for opts in (OPTS, features.FeatureOptions(windows=(1, 2, 4), delay=2, keep_last_day=True)):
        table = _saved(spark, tx.where("tx_time_days <= 10"), opts)
        before = _files(spark, table)
        for day in (11, 13):
            now = tx.where(F.col("tx_time_days") <= day)
            features.update_feature_table(now, table, opts)
            assert _same(spark, table, now, opts)
        after = _files(spark, table)
        assert all(after[d] == f for d, f in before.items()) and len(after) > len(before)
        features.update_feature_table(tx, table, opts)  # nothing new
        assert _files(spark, table) == after


def test_a_late_transaction_rewrites_only_the_days_that_see_it(spark):
    tx = events_transactions(spark, SF001).where("tx_time_days < 16").cache()
    rng = random.Random(2)
    late = [r.transaction_id for r in tx.where("tx_time_days = 4").collect() if rng.random() < 0.3]
    early = tx.where(~F.col("transaction_id").isin(late))
    table = _saved(spark, early, OPTS)
    before = _files(spark, table)
    features.update_feature_table(tx, table, OPTS, changed=4)
    assert _same(spark, table, tx, OPTS)
    touched = {int(d.split("=")[1]) for d, f in _files(spark, table).items() if before.get(d) != f}
    assert touched == set(range(4, 4 + features.reach(OPTS) + 1))


def test_split_of_a_bucketed_table_shuffles_no_features(spark):
    tx = events_transactions(spark, SF001)
    table = _scratch_table(spark, "features_test")
    plain = features.feature_table(tx)
    features.save_feature_table(plain, table, buckets=4)
    opts = split.SplitOptions(start=FIXTURE_SPLIT_START, sort=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = split.test_split(spark.table(table), opts)
        plan = got._jdf.queryExecution().executedPlan().toString()
        main = plan.split("Subquery")[0] if plan.lstrip().startswith("AdaptiveSparkPlan") else plan
        rows = got.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in main and "Exchange" not in main and "Bucketed: true" in main
    assert rows == split.test_split(plain, opts).count()
