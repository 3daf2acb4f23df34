"""The five steps end to end over catalog tables, from a gzip CSV stage."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from txengine.plans import handlers, split
from txengine.plans.catalog_queries import FIXTURE_SPLIT_START
from txengine.session import scratch_path
from txengine.sources.transactions import events_transactions, write_transactions_csv


def test_five_steps(spark):
    stage = scratch_path(spark, "stage_e2e")
    write_transactions_csv(events_transactions(spark, SF001), stage)
    t = handlers.Tables(database="txengine_e2e")
    spark.sql("DROP DATABASE IF EXISTS txengine_e2e CASCADE")
    for _ in range(2):  # setting up twice gives the same tables
        tx = handlers.setup(spark, stage, t)
        assert tx.count() == 10000
    assert spark.table(t.name(t.customers)).count() == 150
    top = handlers.analyse(spark, "top_spenders", t).first()
    assert (top["customer_id"], top["total_spend"], top["percentage_contribution"]) == (128, 5685.67, 1.15)
    feats = handlers.feature_engineering(spark, t)
    assert feats.count() == 9671
    registry = scratch_path(spark, "reg_e2e")
    ml = handlers.machine_learning(
        spark, t, split.SplitOptions(start=FIXTURE_SPLIT_START), registry_path=registry
    )
    assert ml.train.count() == 2325 and ml.test.count() == 1887
    assert ml.scored.count() == 1887
    assert ml.train.agg(F.sum("tx_fraud")).first()[0] == 23
    written = spark.table(t.name(t.scored)).count()
    with pytest.raises(ValueError):  # a version that exists: refused before anything is trained
        handlers.machine_learning(
            spark, t, split.SplitOptions(start="2024-01-02"), registry_path=registry
        )
    assert spark.table(t.name(t.scored)).count() == written
    cm, metrics, frauds = handlers.model_assessment(spark, t)
    assert cm.agg(F.sum(F.col("predicted_0") + F.col("predicted_1"))).first()[0] == 2 * 1887
    assert metrics.count() == 2
    assert frauds.count() == 18
    spark.sql("DROP DATABASE IF EXISTS txengine_e2e CASCADE")


def test_command_line_analyse(spark, capsys):
    from txengine.__main__ import main

    stage = scratch_path(spark, "stage_cli")
    write_transactions_csv(events_transactions(spark, SF001), stage)
    main(["setup", "--csv", stage, "--database", "txengine_cli", "--show", "1"])
    main(["analyse", "--query", "top_spenders", "--database", "txengine_cli", "--show", "1"])
    assert "5685.67" in capsys.readouterr().out
    spark.sql("DROP DATABASE IF EXISTS txengine_cli CASCADE")
