"""Every query with a SQL oracle matches it on the sf0.001 fixture (the driver's check
runs the same comparison at sf0.01), and model queries return rows."""

import pytest

from conftest import SF0001
from oracle_compare import compare
from txengine.plans.catalog_queries import registry

OWN = list(registry())


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF0001, OWN, verbose=False)


def test_all_oracles_match(results):
    bad = {k: v for k, v in results.items() if v[0] not in ("match", "rows-only")}
    assert not bad


def test_every_query_has_rows_or_oracle(results):
    import __spark_entry__ as e

    assert set(results) == set(OWN)
    sql = e.oracle_sql()
    rows_only = sorted(k for k in results if k not in sql)
    assert rows_only == sorted(
        [
            "logistic_scores", "forest_scores", "scored_table", "model_registry_list",
            "registry_scores", "predicted_fraud", "stream_scores", "model_confusion_matrix",
            "model_classification_metrics",
        ]
    )


def test_entry_runs(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert len(df.columns) == 23
    assert df.count() > 0


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def test_column_types_match_oracle(spark):
    import __spark_entry__ as e
    from oracle_compare import duck

    con = duck(SF0001)
    bad = {}
    for k, sql in e.oracle_sql().items():
        if k not in OWN:  # the corpus operators have tests of their own
            continue
        s = dict(e.queries()[k](spark, SF0001).dtypes)
        rel = con.sql(sql)
        d = {c.lower(): str(t) for c, t in zip(rel.columns, rel.types)}
        diff = {c: (t, d.get(c)) for c, t in s.items() if SPARK_TO_DUCK.get(t, t) != d.get(c)}
        if diff:
            bad[k] = diff
    assert not bad


def test_hot_customer_with_every_row_at_midnight(spark):
    """One customer holds half of the rows and every timestamp is midnight."""
    from pyspark.sql import functions as F

    from oracle_compare import digest
    from test_random_plans import _duck
    from txengine import oracle
    from txengine.plans import features
    from txengine.sources.schema import TX_SCHEMA
    from txengine.sources.transactions import lineitem_transactions

    tx = lineitem_transactions(spark, SF0001).limit(1500)
    odd = F.pmod(F.hash("transaction_id", "tx_amount"), F.lit(2)) == 0
    tx = tx.withColumn("customer_id", F.when(odd, F.lit(1)).otherwise(F.col("customer_id")).cast("bigint"))
    data = [tuple(r) for r in tx.collect()]
    df = features.feature_table(spark.createDataFrame(data, TX_SCHEMA))
    rel = _duck(data).sql(oracle.on_table(oracle.FEATURES["feature_table"], "tx_input"))
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(
        [c.lower() for c in rel.columns], rel.fetchall()
    )
