"""Edge cases (FIXTURES.md §4) against the grid-form SQL oracle on the same rows."""

import duckdb
import pytest

import handmade
from oracle_compare import digest
from txengine import oracle
from txengine.plans import calendar, features, split
from txengine.plans.features import FeatureOptions
from txengine.plans.split import SplitOptions

LITERAL = FeatureOptions(literal_current_day_labels=True)


@pytest.fixture(scope="module")
def tx(spark):
    return handmade.spark_table(spark).cache()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    handmade.duck_table(c)
    return c


def _same(sdf, con, sql):
    s_cols = [c.lower() for c in sdf.columns]
    rel = con.sql(oracle.on_table(sql, "tx_input"))
    d_cols = [c.lower() for c in rel.columns]
    s_rows, d_rows = [tuple(r) for r in sdf.collect()], rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    sn, sh = digest(s_cols, s_rows)
    dn, dh = digest(d_cols, d_rows)
    assert sn == dn, f"rows {sn} != {dn}"
    assert sh == dh, _diff(s_cols, s_rows, d_cols, d_rows)


def _diff(s_cols, s_rows, d_cols, d_rows):
    from oracle_compare import _norm

    o_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    o_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    a = {repr(tuple(_norm(r[i]) for i in o_s)) for r in s_rows}
    b = {repr(tuple(_norm(r[i]) for i in o_d)) for r in d_rows}
    return f"cols {[s_cols[i] for i in o_s]}\nspark only {sorted(a - b)[:3]}\nduck only {sorted(b - a)[:3]}"


GRID_KEYS = [
    "date_bounds", "calendar_days", "customer_day_grid", "customer_daily",
    "customer_trailing_daily", "customer_running_day", "terminal_day_grid", "terminal_daily",
    "terminal_trailing_daily", "terminal_running_day",
]


@pytest.mark.parametrize("key", GRID_KEYS)
def test_grid_queries(tx, con, key):
    _same(getattr(calendar, key)(tx), con, oracle.FEATURES[key])


def test_date_time_features(tx, con):
    _same(features.date_time_features(tx), con, oracle.FEATURES["date_time_features"])


LABELS_TODAY = oracle.feature_ctes(labels_today=True)


@pytest.mark.parametrize("key", ["customer_features", "feature_table"])
def test_feature_queries(tx, con, key):
    _same(getattr(features, key)(tx), con, oracle.FEATURES[key])


def test_feature_table_labels_today(tx, con):
    _same(features.feature_table(tx, LITERAL), con, oracle.with_tx("SELECT * FROM features", *LABELS_TODAY))


def test_feature_table_literal_and_all_days(tx, con):
    opts = FeatureOptions(literal_current_day_labels=True, terminal_window_7="literal")
    _same(features.feature_table(tx, opts), con, oracle.FEATURES["feature_table_literal"])
    opts = FeatureOptions(keep_last_day=True)
    _same(features.feature_table(tx, opts), con, oracle.FEATURES["feature_table_all_days"])


def test_terminal_features_both_ways(tx, con):
    _same(features.terminal_features(tx), con, oracle.FEATURES["terminal_features"])
    sql = oracle.FEATURES["terminal_features"].replace(
        ",\n".join(oracle.FEATURE_TABLE_CTES), ",\n".join(LABELS_TODAY)
    )
    _same(features.terminal_features(tx, LITERAL), con, sql)


def test_d18_intent_differs_only_where_labels_are_null(tx):
    """Default (intent) computes the risk on terminal-days whose labels so far today are
    all NULL; the literal option sets it to 0 there. Elsewhere both agree."""
    from pyspark.sql import functions as F

    cols = ["transaction_id", "term_risk_1", "term_risk_7", "term_risk_30"]
    a = features.feature_table(tx).select(*cols)
    b = features.feature_table(tx, LITERAL).select(*[F.col(c).alias(f"l_{c}") for c in cols])
    assert a.count() == b.count()
    a, b = a.distinct(), b.distinct()  # the fixture holds one exact duplicate row
    j = a.join(b, a["transaction_id"] == b["l_transaction_id"])
    assert j.count() == a.count() == b.count()
    diff = j.filter(
        "term_risk_1 <> l_term_risk_1 OR term_risk_7 <> l_term_risk_7 OR term_risk_30 <> l_term_risk_30"
    ).collect()
    # only the terminal-12 rows of day 5 whose labels so far are NULL may differ
    null_label_ids = {r[0] for r in handmade.rows() if r[3] == 12 and r[6] == 5 and r[7] is None}
    assert {r["transaction_id"] for r in diff} <= null_label_ids
    for r in diff:
        assert r["l_term_risk_1"] == r["l_term_risk_7"] == r["l_term_risk_30"] == 0.0


@pytest.fixture(scope="module")
def feats(tx):
    return features.feature_table(tx).cache()


@pytest.mark.parametrize("key", ["train_split", "test_split", "known_fraud_asof", "split_stats"])
def test_split_queries(feats, con, key):
    opts = SplitOptions(start=handmade.SPLIT_START)
    _same(getattr(split, key)(feats, opts), con, oracle.split_queries(handmade.SPLIT_START)[key])


def test_split_boundaries(feats):
    opts = SplitOptions(start=handmade.SPLIT_START, sort=False)
    train = split.train_split(feats, opts)
    days = {r[0] for r in train.select("tx_time_days").distinct().collect()}
    # midnight of the end day is inside the training period (D8)
    assert max(days) == handmade.S0 + 7
    assert min(days) == handmade.S0
    test = split.test_split(feats, opts)
    tdays = {r[0] for r in test.select("tx_time_days").distinct().collect()}
    assert tdays and not (tdays & days)
    known = {r["customer_id"]: r["known_from"] for r in split.known_fraud_asof(feats, opts).collect()}
    s0 = handmade.S0
    # training fraud -> first test day; delay-day fraud on f -> f + 8; s0+5 is not a delay day
    assert known[26] == s0 + 14
    assert known[22] == s0 + 6 + 8
    assert known[23] == s0 + 7 + 8
    assert known[24] == s0 + 12 + 8
    assert 25 not in known or known[25] > s0 + 20
    for r in test.select("customer_id", "tx_time_days").collect():
        assert not (r[0] in known and known[r[0]] <= r[1])
    # the exact duplicate test row is kept once (set union, D16)
    assert test.count() == test.distinct().count()
