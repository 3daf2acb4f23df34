"""Properties of the feature table and golden numbers of the fixture profile (FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from txengine.plans import analysis, features
from txengine.sources.transactions import events_transactions


@pytest.fixture(scope="module")
def ft(spark):
    return features.feature_table(events_transactions(spark, SF001)).cache()


def test_golden_profile_sf0001(spark):
    tx = events_transactions(spark, SF0001)
    assert tx.count() == 1000
    assert tx.agg(F.sum("tx_fraud")).first()[0] == 8
    flags = features.date_time_features(tx).agg(
        F.sum("tx_during_weekend"), F.sum("tx_during_night")
    ).first()
    assert tuple(flags) == (268, 367)
    by = {r[0]: r[1] for r in tx.groupBy("tx_fraud_scenario").count().collect()}
    assert by == {0: 992, 1: 2, 2: 3, 3: 3}
    top = analysis.top_spenders(tx).first()
    assert (top["customer_id"], top["total_spend"], top["percentage_contribution"]) == (9, 3896.32, 7.78)


def test_golden_feature_table_sf001(ft):
    assert ft.count() == 9671
    assert ft.filter(F.col("nb_tx_window_1").isNull()).count() == 364
    assert ft.filter(F.col("term_risk_1") > 0).count() == 197


def test_literal_window_7_differs_as_documented(spark, ft):
    lit = features.feature_table(
        events_transactions(spark, SF001), features.FeatureOptions(terminal_window_7="literal")
    )
    j = ft.select("transaction_id", "term_risk_7").join(
        lit.select("transaction_id", F.col("term_risk_7").alias("lit7"), "term_risk_1"),
        "transaction_id",
    )
    assert j.filter("lit7 <> term_risk_1").count() == 0  # D4: literal 7-day = 1-day
    assert j.filter("lit7 <> term_risk_7").count() == 934


def test_counts_monotone_and_risk_bounded(ft):
    bad = ft.filter(
        (F.col("cust_cnt_tx_1") > F.col("cust_cnt_tx_7"))
        | (F.col("cust_cnt_tx_7") > F.col("cust_cnt_tx_30"))
        | (F.col("cust_cnt_tx_1") < 1)
        | ~F.col("term_risk_1").between(0, 1)
        | ~F.col("term_risk_7").between(0, 1)
        | ~F.col("term_risk_30").between(0, 1)
    )
    assert bad.count() == 0


def test_no_leakage(spark, ft):
    """Features of a row do not change when every later row is removed."""
    cut = "2024-01-18 12:00:00"
    tx = events_transactions(spark, SF001)
    # keep the calendar's last day in the truncated table, so that D3 drops the same day
    last = tx.agg(F.max("tx_datetime")).first()[0]
    early = tx.filter((F.col("tx_datetime") <= F.lit(cut).cast("timestamp_ntz")) | (F.col("tx_datetime") == F.lit(last)))
    part = features.feature_table(early).filter(F.col("tx_datetime") <= F.lit(cut).cast("timestamp_ntz"))
    full = ft.filter(F.col("tx_datetime") <= F.lit(cut).cast("timestamp_ntz"))
    assert part.count() == full.count() > 0
    assert part.exceptAll(full).count() == 0


def test_same_result_with_1_and_64_partitions(spark):
    tx = events_transactions(spark, SF0001)
    out = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(tuple(r) for r in features.feature_table(tx).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]


def test_golden_split_sf0001(spark):
    import __spark_entry__ as e

    got = {r["split"]: (r["rows"], r["frauds"]) for r in e.queries()["split_stats"](spark, SF0001).collect()}
    assert got == {"train": (246, 2), "test": (156, 1)}
