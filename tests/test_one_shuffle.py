"""What the feature table moves: the customer side is shuffled once, lineitem and orders are joined
once, and rows travel without the columns that follow from others."""

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import SF0001
from txengine.operators.running import running_per_timestamp
from txengine.operators.trailing import trailing_behind_running
from txengine.plans import features
from txengine.plans.catalog_queries import registry
from txengine.sources.transactions import lineitem_transactions


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> list[str]:
    return [x for x in plan.splitlines() if " Exchange " in f" {x.strip(' +-:|')} "]


def test_customer_side_is_shuffled_once(spark):
    parts = features.transaction_parts(lineitem_transactions(spark, SF0001))
    plan = _plan(features._per_timestamp(parts, features.DEFAULT))
    assert plan.count("Window [") >= 3
    assert len(_exchanges(plan)) == 1 and "Join" not in plan


def test_lineitem_and_orders_are_joined_once(spark):
    """What is left to run reads the written join; lineitem again for the first day alone."""
    plan = _plan(registry()["lineitem_feature_table"](spark, SF0001))
    assert "orders.parquet" not in plan
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x and "lineitem.parquet" in x]
    assert all("FileScan parquet [l_shipdate#" in x for x in scans)


def test_rows_move_without_derived_columns(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry()["lineitem_feature_table"](spark, SF0001)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    top, joins = plan[: plan.index("Join")], plan[plan.index("Join") :]
    for name in ("tx_time_seconds", "tx_time_days", "tx_fraud_scenario", "tx_during_weekend", "tx_during_night"):
        assert name in top and name not in joins


def test_frames_over_days_with_many_timestamps(spark):
    """A key with several hundred timestamps a day, one with few, gaps, and sums that a day may not have."""
    rng, rows = random.Random(5), []
    for key, days, each in ((1, (0, 1, 2, 5, 9), 300), (2, (0, 3, 4), 2), (3, (7,), 1)):
        for day in days:
            for s in sorted(rng.sample(range(86400), each)):
                ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=day, seconds=s)
                rows.append((key, ts, rng.randint(1, 9), None if day == 1 else rng.randint(0, 3)))
    per_ts = spark.createDataFrame(rows, "key long, ts timestamp_ntz, n long, m long")
    run = running_per_timestamp(per_ts, "key", "ts", ["n", "m"])
    frames = {"n_1": ("run_n", -1, -1), "n_7": ("run_n", -7, -1), "m_2": ("run_m", -2, -1)}
    got = trailing_behind_running(run, "key", "_day", "ts", frames).collect()

    def over(column, key, day, back):
        found = [r[column] for r in rows if r[0] == key and 1 <= (day - r[1].date()).days <= back]
        known = [v for v in found if v is not None]
        return sum(known) if known else None

    assert len(got) == len(rows)
    want = {}
    for r in got:
        at = (r["key"], r["ts"].date())
        if at not in want:
            want[at] = (over(2, *at, 1), over(2, *at, 7), over(3, *at, 2))
        assert (r["n_1"], r["n_7"], r["m_2"]) == want[at]
        so_far = [x[2] for x in rows if x[0] == at[0] and x[1].date() == at[1] and x[1] <= r["ts"]]
        assert r["run_n"] == sum(so_far)


def test_feature_table_same_with_columns_derived_behind_the_joins(spark):
    a = registry()["lineitem_feature_table"](spark, SF0001)
    b = features.feature_table(lineitem_transactions(spark, SF0001))
    rounded = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in a.dtypes]
    assert a.dtypes == b.dtypes
    assert a.select(rounded).exceptAll(b.select(rounded)).count() == 0 and a.count() == b.count() > 0
