"""Randomized tables (ties within a second and across seconds, NULL amounts, labels,
customers and terminals, zero and negative amounts): the direct and the salted customer
plans and the grid-form oracle agree."""

import datetime as dt

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oracle_compare import digest
from txengine import oracle
from txengine.plans import features
from txengine.sources.schema import TX_COLUMNS, TX_SCHEMA

DAY0 = dt.datetime(2024, 5, 1)

row = st.tuples(
    st.integers(0, 12),  # day
    st.integers(0, 3),  # second bucket (few values -> ties)
    st.sampled_from([0, 0, 250_000, 500_000]),  # microseconds
    st.one_of(st.none(), st.integers(1, 4)),  # customer
    st.one_of(st.none(), st.integers(10, 12)),  # terminal
    st.one_of(st.none(), st.sampled_from([0.0, -3.5, 10.25, 99.99, 150.5])),  # amount
    st.one_of(st.none(), st.integers(0, 1)),  # label
)


def _table(rows):
    out = []
    for i, (day, sec, micro, cust, term, amount, fraud) in enumerate(rows):
        ts = DAY0 + dt.timedelta(days=day, seconds=sec * 7, microseconds=micro)
        out.append((i, ts, cust, term, amount, day * 86400 + sec * 7, day, fraud, 0))
    return out


def _duck(rows):
    con = duckdb.connect()
    pdf = pd.DataFrame(rows, columns=TX_COLUMNS)
    for c in ["transaction_id", "customer_id", "terminal_id", "tx_time_seconds", "tx_time_days",
              "tx_fraud", "tx_fraud_scenario"]:
        pdf[c] = pdf[c].astype("Int64")
    pdf["tx_amount"] = pdf["tx_amount"].astype("Float64")
    con.register("tx_pdf", pdf)
    con.execute("CREATE TABLE tx_input AS SELECT * FROM tx_pdf")
    return con


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=3, max_size=40))
def test_plans_agree_with_oracle(spark, rows):
    data = _table(rows)
    tx = spark.createDataFrame(data, TX_SCHEMA)
    con = _duck(data)
    for today in (False, True):
        sql = oracle.with_tx("SELECT * FROM features", *oracle.feature_ctes(labels_today=today))
        rel = con.sql(oracle.on_table(sql, "tx_input"))
        df = features.feature_table(tx, features.FeatureOptions(literal_current_day_labels=today))
        got = digest(df.columns, [tuple(r) for r in df.collect()])
        assert got == digest([c.lower() for c in rel.columns], rel.fetchall()), today


split_row = st.tuples(
    st.integers(0, 30),  # day
    st.integers(0, 86_399),  # second of the day
    st.integers(1, 6),  # customer
    st.integers(10, 12),  # terminal
    st.sampled_from([5.0, 20.5, 180.0]),  # amount
    st.sampled_from([0, 0, 0, 1]),  # label
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(split_row, min_size=20, max_size=80),
    st.integers(2, 6),
    st.integers(1, 5),
    st.integers(1, 6),
)
def test_split_matches_the_loop(spark, rows, train, delay, test):
    from test_options import _loop_split

    from txengine.plans import split

    data = []
    for i, (day, sec, cust, term, amount, fraud) in enumerate(rows):
        ts = DAY0 + dt.timedelta(days=day, seconds=sec)
        data.append((i, ts, cust, term, amount, day * 86400 + sec, day, fraud, 0))
    # make sure the training period holds a row, so that s0 exists, and that the calendar
    # (whose last date is dropped, D3) reaches past it
    data.append((len(data), DAY0 + dt.timedelta(days=3), 1, 10, 5.0, 3 * 86400, 3, 0, 0))
    data.append((len(data), DAY0 + dt.timedelta(days=45), 1, 10, 5.0, 45 * 86400, 45, 0, 0))
    feats = features.feature_table(spark.createDataFrame(data, TX_SCHEMA)).cache()
    start = (DAY0 + dt.timedelta(days=3)).strftime("%Y-%m-%d")
    expected = _loop_split(feats.collect(), start, train, delay, test)
    opts = split.SplitOptions(start=start, train_days=train, delay_days=delay, test_days=test)
    assert {tuple(r) for r in split.test_split(feats, opts).collect()} == expected
    feats.unpersist()


tx_row = st.tuples(
    st.integers(0, 5),  # day
    st.one_of(st.none(), st.integers(1, 5)),  # customer
    st.one_of(st.none(), st.integers(10, 12)),  # terminal
    st.one_of(st.none(), st.sampled_from([0.0, -2.5, 0.49, 0.5, 12.5, 99.99, 151.25])),
    st.one_of(st.none(), st.integers(0, 1)),  # label
    st.one_of(st.none(), st.integers(0, 3)),  # scenario
)

ANALYSIS_KEYS = [
    "tx_count", "amount_summary", "amount_by_scenario", "avg_by_scenario", "top_spenders",
    "numeric_describe", "tx_by_day", "fraud_share", "fraud_by_customer", "distinct_customers",
    "distinct_terminals",
]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(tx_row, min_size=1, max_size=30))
def test_analysis_queries_with_nulls(spark, rows):
    from txengine.plans import analysis

    data = [
        (i, DAY0 + dt.timedelta(days=d, hours=i % 24), c, t, a, d * 86400, d, f, s)
        for i, (d, c, t, a, f, s) in enumerate(rows)
    ]
    tx = spark.createDataFrame(data, TX_SCHEMA)
    con = _duck(data)
    for key in ANALYSIS_KEYS:
        df = getattr(analysis, key)(tx)
        rel = con.sql(oracle.on_table(oracle.ANALYSIS[key], "tx_input"))
        got = digest(df.columns, [tuple(r) for r in df.collect()])
        assert got == digest([c.lower() for c in rel.columns], rel.fetchall()), key
