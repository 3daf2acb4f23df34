"""Queries on the logistic model grow no forest, whose trees the driver would have to hold."""

import pytest

from txengine.plans import catalog_queries, models


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events"))
    rows = spark.range(3000).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 860) as ts",
        "id % 37 as user_id", "if(id % 7 = 0, 'error', 'view') as event_type",
        "cast(id * 53 % 200 as double) as value", "concat('{\"k\": ', id % 11, '}') as props",
    )
    rows.write.parquet(f"{path}/events.parquet")
    return path


def test_logistic_queries_grow_no_forest(spark, events, monkeypatch):
    def no_forest(*_):
        raise AssertionError("a forest was grown")

    with monkeypatch.context() as patched:
        patched.setattr(models, "fit_forest_on", no_forest)
        q = catalog_queries.registry()
        rows = q["logistic_scores"](spark, events).count()
        assert rows > 0 and q["registry_scores"](spark, events).count() == rows
        assert q["stream_scores"](spark, events).count() == rows
        assert q["predicted_fraud"](spark, events).count() <= rows
        assert q["predicted_fraud_differences"](spark, events).first() == (rows, 0)
        assert q["logistic_optimum"](spark, events).count() == len(models.ModelOptions().features) + 1
        entry = q["model_registry_list"](spark, events).first()
        assert entry.train_rows == entry.training_set_rows > 0
    lm, n = catalog_queries.fixture_logistic(spark, events)
    both = catalog_queries.fixture_models(spark, events)
    assert both.lm is lm and both.rows == n and both.rf.stages[-1].getNumTrees == 100
