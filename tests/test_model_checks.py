"""The models against what is computed without Spark ML: Newton's method, a forest walked row by
row from its node table, the stored coefficients; registry writers at the same time."""

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from txengine.plans import model_checks, models
from txengine.plans.catalog_queries import fixture_models, fixture_split
from txengine.plans.registry import ModelRegistry, claim
from txengine.session import scratch_path

OPTS = models.ModelOptions()


@pytest.fixture(scope="module")
def fitted(spark):
    return fixture_models(spark, SF001)


@pytest.fixture(scope="module")
def sets(spark):
    return fixture_split(spark, SF001)


def test_logistic_fit_is_newtons(fitted, sets):
    rows = sets[0].select(*OPTS.features, OPTS.label).toPandas().astype(float)
    x = np.c_[rows[list(OPTS.features)].to_numpy(), np.ones(len(rows))]
    y = rows[OPTS.label].to_numpy()
    penalty = np.diag(np.r_[np.ones(x.shape[1] - 1), 0.0])  # C = 1 on the summed loss
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (p - y) + penalty @ w)
        w -= step * min(1.0, 5.0 / np.abs(step).max())
    assert np.abs(step).max() < 1e-9
    lr = fitted.lm.stages[-1]
    got = 1 / (1 + np.exp(-(x[:, :-1] @ lr.coefficients.toArray() + lr.intercept)))
    assert np.abs(got - 1 / (1 + np.exp(-x @ w))).max() < 2e-3
    checked = {r.coefficient: r for r in model_checks.logistic_gradient(fitted.lm, sets[0]).collect()}
    assert list(checked) == [*OPTS.features, "intercept"] and all(r.at_optimum for r in checked.values())


def test_a_fit_that_stops_early_is_noticed(sets):
    early = models.fit_logistic(sets[0], models.ModelOptions(lr_max_iter=2))
    assert not all(r.at_optimum for r in model_checks.logistic_gradient(early, sets[0]).collect())


def test_forest_as_a_table(spark, fitted, sets):
    scored = models.score_forest(fitted.rf, sets[1]).limit(300).cache()
    assert model_checks.forest_differences(fitted.rf, scored, "transaction_id").first() == (300, 0)
    wrong = scored.withColumn("fraud_probability_rf", F.col("fraud_probability_rf") + F.when(F.col("transaction_id") % 2 == 0, 1e-6).otherwise(0))
    assert model_checks.forest_differences(fitted.rf, wrong, "transaction_id").first().different > 0
    nodes = model_checks.forest_nodes(fitted.rf, spark).collect()
    tree = {(n.tree, n.node): n for n in nodes}
    for r in scored.limit(20).collect():
        total = 0.0
        for t in range(100):
            n = tree[t, 0]
            while n.fraud is None:
                n = tree[t, n.left_child if float(r[OPTS.features[n.feature]]) <= n.threshold else n.right_child]
            total += n.fraud
        assert r.fraud_probability_rf == pytest.approx(total / 100, abs=1e-9)


def test_flags_follow_from_the_coefficients(fitted, sets):
    scored = models.score_logistic(fitted.lm, sets[1])
    n = sets[1].count()
    assert model_checks.logistic_differences(fitted.lm, scored).first() == (n, 0)
    flipped = scored.withColumn("prediction_lm", 1 - F.col("prediction_lm"))
    assert model_checks.logistic_differences(fitted.lm, flipped).first() == (n, n)


def test_one_of_two_writers_gets_a_version(spark, fitted):
    reg = ModelRegistry.create(spark, scratch_path(spark, "registry_two"))
    reg.refuse_existing = lambda name, version: None  # both have looked before either writes

    def write(k):
        try:
            return reg.log_model("m", "v1", fitted.lm, {"writer": k})
        except ValueError as e:
            return str(e)

    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(write, range(4)))
    assert sum(not isinstance(g, str) for g in got) == 1
    assert reg.list_models().count() == 1


def test_the_newest_deployment_is_the_highest_number(spark, fitted, monkeypatch):
    import datetime as dt

    from txengine.plans import registry

    monkeypatch.setattr(registry, "_now", lambda: dt.datetime(2024, 1, 1))  # all at the same time
    reg = ModelRegistry.create(spark, scratch_path(spark, "registry_ties"))
    for v in ("v1", "v2", "v3"):
        reg.log_model("m", v, fitted.lm)
    for v in ("v1", "v3", "v2"):
        reg.deploy("scoring", "m", v)
        assert reg.deployed("scoring").version == v
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda v: reg.deploy("other", "m", v), ["v1", "v2", "v3"]))
    numbers = [r.number for r in reg._deployments("other").collect()]
    assert sorted(numbers) == [1, 2, 3]


def test_a_claim_is_granted_once(spark):
    path = scratch_path(spark, "claim")
    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(lambda _: claim(spark, f"{path}/x/y"), range(16))) == 1
