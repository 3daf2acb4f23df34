"""Non-default options: last calendar day kept, other windows, other split lengths (the
per-day known-fraud loop, run in plain Python on the collected hand-made rows)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import handmade
from txengine.plans import features, split
from txengine.plans.features import FeatureOptions
from txengine.plans.split import SplitOptions


@pytest.fixture(scope="module")
def tx(spark):
    return handmade.spark_table(spark).cache()


def test_keep_last_day_adds_only_that_day(tx):
    base = features.feature_table(tx)
    kept = features.feature_table(tx, FeatureOptions(keep_last_day=True))
    last = tx.agg(F.max("tx_time_days")).first()[0]
    extra = kept.exceptAll(base)
    assert extra.count() == kept.count() - base.count() > 0
    assert {r[0] for r in extra.select("tx_time_days").distinct().collect()} == {last}
    # earlier rows are unchanged by keeping the last day
    assert base.exceptAll(kept.filter(F.col("tx_time_days") < last)).count() == 0


def test_other_windows(tx):
    opts = FeatureOptions(windows=(2, 14))
    df = features.feature_table(tx, opts)
    for c in ["cust_cnt_tx_2", "cust_avg_amount_14", "nb_tx_window_2", "term_risk_14"]:
        assert c in df.columns
    assert df.filter(F.col("cust_cnt_tx_2") > F.col("cust_cnt_tx_14")).count() == 0


def _loop_split(rows, start: str, train: int, delay: int, test: int):
    """The reference's per-day loop, literally, over Python rows."""
    t0 = dt.datetime.strptime(start, "%Y-%m-%d")
    t1 = t0 + dt.timedelta(days=train)
    tr = [r for r in rows if t0 <= r["tx_datetime"] <= t1]
    s0 = min(r["tx_time_days"] for r in tr)
    known = {r["customer_id"] for r in tr if r["tx_fraud"] == 1}
    out = set()
    for day in range(test):
        today = [r for r in rows if r["tx_time_days"] == s0 + train + delay + day]
        delay_day = [r for r in rows if r["tx_time_days"] == s0 + train + day - 1]
        known |= {r["customer_id"] for r in delay_day if r["tx_fraud"] == 1}
        out |= {tuple(r) for r in today if r["customer_id"] not in known}
    return out


@pytest.mark.parametrize("train,delay,test", [(7, 7, 7), (5, 3, 4), (3, 1, 9)])
def test_split_lengths_match_the_loop(tx, train, delay, test):
    feats = features.feature_table(tx).cache()
    rows = feats.collect()
    expected = _loop_split(rows, handmade.SPLIT_START, train, delay, test)
    opts = SplitOptions(start=handmade.SPLIT_START, train_days=train, delay_days=delay, test_days=test)
    got = {tuple(r) for r in split.test_split(feats, opts).collect()}
    assert got == expected
    feats.unpersist()
