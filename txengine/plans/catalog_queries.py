"""Query keys -> callables ``(spark, sf_dir) -> DataFrame`` over the driver's fixture
tables. Every query reads the given tables (``events``, or ``lineitem`` + ``orders`` for
the wide-calendar feature table, adapted to transactions) and runs over all their rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.operators.joins import materialize
from txengine.plans import analysis
from txengine.session import scratch_path
from txengine.sources.catalog import create_namespace, create_transaction_table
from txengine.sources.schema import FEATURE_TABLE_COLUMNS
from txengine.sources.transactions import (
    copy_into,
    events_transactions,
    lineitem_derived,
    lineitem_joined,
    load_transactions,
    write_transactions_csv,
)

Query = Callable[[SparkSession, str], DataFrame]


def _on_tx(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(events_transactions(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


SCRATCH_DATABASE = "txengine_scratch"


def _scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh table name in the scratch database of the catalog."""
    create_namespace(spark, SCRATCH_DATABASE)
    return f"{SCRATCH_DATABASE}.{name}_{uuid.uuid4().hex[:12]}"


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """What tells one state of the fixture from another: its files, sizes and times. Work
    kept for later queries is kept by this, so that changed data is never answered from it."""
    files = spark.read.format("binaryFile").load(f"{sf_dir}/events.parquet")
    mark = F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")
    seen = files.agg(F.count(F.lit(1)), F.sum(mark)).first()
    return (spark.sparkContext.applicationId, sf_dir, seen[0], str(seen[1]))


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage the transactions as gzip CSV in the shared folder, COPY them into a managed
    table with the typed reader, and read that table (S2-S5, S7)."""
    path, table = scratch_path(spark, "stage"), _scratch_table(spark, "transactions")
    write_transactions_csv(events_transactions(spark, sf_dir), path)
    create_transaction_table(spark, table)
    copy_into(spark, path, table)
    return load_transactions(spark, table)


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name in [
        "tx_scan", "tx_count", "amount_summary", "amount_by_scenario", "avg_by_scenario",
        "top_spenders", "numeric_describe", "tx_by_day", "fraud_share",
        "fraud_by_customer", "distinct_customers", "distinct_terminals",
    ]:
        q[name] = _on_tx(getattr(analysis, name))
    q["csv_ingest"] = csv_ingest
    q.update(_features_registry())
    q.update(_split_registry())
    q.update(_models_registry())
    return q


def _features_registry() -> dict[str, Query]:
    from txengine.plans import calendar, features

    q: dict[str, Query] = {}
    for name in [
        "date_bounds", "calendar_days", "customer_day_grid", "customer_daily",
        "customer_trailing_daily", "customer_running_day", "terminal_day_grid",
        "terminal_daily", "terminal_trailing_daily", "terminal_running_day",
    ]:
        q[name] = _on_tx(getattr(calendar, name))
    for name in ["date_time_features", "customer_features", "terminal_features", "feature_table"]:
        q[name] = _on_tx(getattr(features, name))

    def lineitem_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The feature table on the wide-calendar fixture (lineitem + orders): 2,498 days,
        every timestamp at midnight, so all of a day's rows are RANGE peers. The two tables are
        joined once and written, with the columns from which the others follow."""
        tx = materialize(spark, lineitem_joined(spark, sf_dir), "lineitem_joined")
        return features.feature_table(tx, stored=True, derive=lambda rows: lineitem_derived(rows, sf_dir))

    def feature_table_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The feature table with the reference's own terminal columns (D4, D18)."""
        opts = features.FeatureOptions(terminal_window_7="literal", literal_current_day_labels=True)
        return features.feature_table(events_transactions(spark, sf_dir), opts)

    def feature_table_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The feature table with the last calendar day's rows (D3)."""
        opts = features.FeatureOptions(keep_last_day=True)
        return features.feature_table(events_transactions(spark, sf_dir), opts)

    def feature_table_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The feature table saved as a catalog table and read back (S10)."""
        table = _scratch_table(spark, "features")
        features.save_feature_table(features.feature_table(events_transactions(spark, sf_dir)), table)
        return spark.table(table).select(*FEATURE_TABLE_COLUMNS)

    def feature_table_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The feature table saved without the last five days, then brought up to date (S10)."""
        table, tx = _scratch_table(spark, "features"), events_transactions(spark, sf_dir)
        last = tx.select(F.max("tx_time_days")).scalar()
        features.save_feature_table(features.feature_table(tx.where(F.col("tx_time_days") <= last - 5)), table)
        features.update_feature_table(tx, table)
        return spark.table(table).select(*FEATURE_TABLE_COLUMNS)

    q["feature_table_updated"] = feature_table_updated
    q["lineitem_feature_table"] = lineitem_feature_table
    q["feature_table_literal"] = feature_table_literal
    q["feature_table_all_days"] = feature_table_all_days
    q["feature_table_saved"] = feature_table_saved
    return q


# First training day of the events fixture (FIXTURES.md §2); the reference uses 2019-05-25.
FIXTURE_SPLIT_START = "2024-01-09"


_WRITTEN: dict[tuple, tuple] = {}


def fixture_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved feature table the split and models read, as the reference reads its
    saved table: written once per application and fixture into the shared folder,
    partitioned by TX_TIME_DAYS so that per-day filters prune files."""
    from txengine.plans.features import clustered_by_day, feature_table

    key = _state(spark, sf_dir)
    if key not in _WRITTEN:
        path = scratch_path(spark, "feature_table")
        df = feature_table(events_transactions(spark, sf_dir))
        clustered_by_day(df).write.partitionBy("tx_time_days").parquet(path)
        _WRITTEN[key] = (path, df.schema)
    path, schema = _WRITTEN[key]
    # the declared schema keeps the partition column BIGINT (inference would make it INT)
    return spark.read.schema(schema).parquet(path).select(*FEATURE_TABLE_COLUMNS)


def _split_registry() -> dict[str, Query]:
    from txengine.plans import split

    opts = split.SplitOptions(start=FIXTURE_SPLIT_START)

    def make(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(fixture_features(spark, sf_dir), opts)

        run.__name__ = fn.__name__
        return run

    return {
        name: make(getattr(split, name))
        for name in ["train_split", "known_fraud_asof", "test_split", "split_stats"]
    }


# ----------------------------------------------------------------------------- models
_FITTED: dict[tuple, tuple] = {}
_LOGISTIC: dict[tuple, tuple] = {}
_REGISTERED: dict[tuple, tuple] = {}


def fixture_split(spark: SparkSession, sf_dir: str):
    from txengine.plans import split

    opts = split.SplitOptions(start=FIXTURE_SPLIT_START, sort=False)
    feats = fixture_features(spark, sf_dir)
    return split.train_split(feats, opts), split.test_split(feats, opts)


def fixture_models(spark: SparkSession, sf_dir: str):
    """Both models, fitted once for each state of the fixture (train once, score many)."""
    from txengine.plans import models

    key = _state(spark, sf_dir)
    if key not in _FITTED:
        train, _ = fixture_split(spark, sf_dir)
        m = _FITTED[key] = models.fit_all(train, lm=_LOGISTIC.get(key, (None,))[0])
        _LOGISTIC[key] = (m.lm, m.rows)
    return _FITTED[key]


def fixture_logistic(spark: SparkSession, sf_dir: str):
    """The logistic model and its training rows, for queries that use no forest: the same model
    as in ``fixture_models``, whichever is asked for first."""
    from txengine.plans import models

    key = _state(spark, sf_dir)
    if key not in _LOGISTIC:
        train, _ = fixture_split(spark, sf_dir)
        _LOGISTIC[key] = models.fit_logistic_counted(train)
    return _LOGISTIC[key]


def _models_registry() -> dict[str, Query]:
    from txengine.plans import assessment, model_checks, models
    from txengine.plans.registry import ModelRegistry

    def logistic_scores(spark, sf_dir):
        lm, _ = fixture_logistic(spark, sf_dir)
        return models.score_logistic(lm, fixture_split(spark, sf_dir)[1])

    def forest_scores(spark, sf_dir):
        rf = fixture_models(spark, sf_dir).rf
        return models.score_forest(rf, fixture_split(spark, sf_dir)[1])

    def scored(spark, sf_dir):
        m = fixture_models(spark, sf_dir)
        return models.score_both(m.lm, m.rf, fixture_split(spark, sf_dir)[1])

    def scored_table(spark, sf_dir):
        """The test set scored by both models, saved as a catalog table and read back."""
        table = _scratch_table(spark, "scored")
        models.save_scored(scored(spark, sf_dir), table)
        return spark.table(table)

    def scored_table_carried(spark, sf_dir):
        """The 23 columns that the saved scored table carries along."""
        return scored_table(spark, sf_dir).select(*FEATURE_TABLE_COLUMNS)

    def model_confusion_totals(spark, sf_dir):
        """Rows and actual frauds that each model's confusion matrix adds up to."""
        m = assessment.confusion_matrix(scored(spark, sf_dir))
        n = F.col("predicted_0") + F.col("predicted_1")
        return m.groupBy("model").agg(
            F.sum(n).cast("bigint").alias("rows"),
            F.sum(F.when(F.col("actual") == 1, n).otherwise(0)).cast("bigint").alias("frauds"),
        )

    def _registered(spark, sf_dir):
        """The logistic model logged and deployed once for each state of the fixture."""
        key = _state(spark, sf_dir)
        if key not in _REGISTERED:
            lm, rows = fixture_logistic(spark, sf_dir)
            reg = ModelRegistry.create(spark, scratch_path(spark, "registry"))
            ref = reg.log_model("logistic_fraud_detection", "v1", lm, {"maxIter": 1000}, rows)
            reg.deploy("fraud_scoring", "logistic_fraud_detection", "v1")
            _REGISTERED[key] = (reg, ref)
        return _REGISTERED[key]

    def model_registry_list(spark, sf_dir):
        """The registry's entries beside the size of the training set in the data."""
        reg, _ = _registered(spark, sf_dir)
        n = fixture_split(spark, sf_dir)[0].select(F.count(F.lit(1))).scalar()
        return reg.list_models().withColumn("training_set_rows", n)

    def registered_training_rows(spark, sf_dir):
        """What the registry says each version was trained on."""
        return model_registry_list(spark, sf_dir).select("name", "version", "train_rows", "training_set_rows")

    def registry_prediction_differences(spark, sf_dir):
        """Test rows, and those on which the deployed model and the fitted one disagree."""
        reg, _ = _registered(spark, sf_dir)
        test = scored(spark, sf_dir).withColumnRenamed("prediction_lm", "direct").drop("fraud_probability_lm")
        again = reg.predict("fraud_scoring", test)
        differs = F.when(F.col("direct") != F.col("prediction_lm"), 1).otherwise(0)
        return again.agg(
            F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(differs), F.lit(0)).cast("bigint").alias("different")
        )

    def logistic_optimum(spark, sf_dir):
        """Per coefficient, whether the fit stands where the penalised gradient vanishes (M2)."""
        lm, _ = fixture_logistic(spark, sf_dir)
        checked = model_checks.logistic_gradient(lm, fixture_split(spark, sf_dir)[0])
        return checked.select("coefficient", "at_optimum")

    def forest_table_differences(spark, sf_dir):
        """Test rows, and those that the forest's node table scores otherwise (M3, M4)."""
        rf = fixture_models(spark, sf_dir).rf
        rows = models.score_forest(rf, fixture_split(spark, sf_dir)[1])
        return model_checks.forest_differences(rf, rows, "transaction_id")

    def predicted_fraud_differences(spark, sf_dir):
        """Test rows, and those that the registered model flags as fraud but its stored
        coefficients do not, or the other way round (P9, M10)."""
        _, ref = _registered(spark, sf_dir)
        return model_checks.logistic_differences(ref.load(), registry_scores(spark, sf_dir))

    def registry_scores(spark, sf_dir):
        _, ref = _registered(spark, sf_dir)
        return ref.predict(fixture_split(spark, sf_dir)[1])

    def stream_scores(spark, sf_dir):
        from txengine.streaming.scoring import score_folder

        _, ref = _registered(spark, sf_dir)
        return score_folder(spark, ref, fixture_split(spark, sf_dir)[1])

    def predicted_fraud(spark, sf_dir):
        return assessment.predicted_fraud(registry_scores(spark, sf_dir))

    def model_confusion_matrix(spark, sf_dir):
        return assessment.confusion_matrix(scored(spark, sf_dir))

    def model_classification_metrics(spark, sf_dir):
        return assessment.classification_metrics(scored(spark, sf_dir))

    def rule(fn):
        def run(spark, sf_dir):
            return fn(assessment.rule_scored(fixture_split(spark, sf_dir)[1]))

        run.__name__ = fn.__name__
        return run

    return {
        "logistic_scores": logistic_scores,
        "forest_scores": forest_scores,
        "scored_table": scored_table,
        "scored_table_carried": scored_table_carried,
        "model_confusion_totals": model_confusion_totals,
        "registered_training_rows": registered_training_rows,
        "registry_prediction_differences": registry_prediction_differences,
        "logistic_optimum": logistic_optimum,
        "forest_table_differences": forest_table_differences,
        "predicted_fraud_differences": predicted_fraud_differences,
        "model_registry_list": model_registry_list,
        "registry_scores": registry_scores,
        "predicted_fraud": predicted_fraud,
        "stream_scores": stream_scores,
        "model_confusion_matrix": model_confusion_matrix,
        "model_classification_metrics": model_classification_metrics,
        "confusion_matrix": rule(assessment.confusion_matrix),
        "classification_metrics": rule(assessment.classification_metrics),
        "actual_fraud_rows": rule(assessment.actual_fraud_rows),
    }
