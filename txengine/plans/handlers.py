"""The reference's five steps as functions of a session that return a DataFrame, over
catalog tables: set up and load, analyse, build and save features, split / train / score /
register, assess. Table names default to the reference's (lower-cased)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from txengine.plans import analysis, assessment, features, models, split
from txengine.plans.registry import ModelRegistry
from txengine.sources.catalog import create_namespace, create_transaction_table, dimension, save_table
from txengine.sources.transactions import copy_into, load_transactions


@dataclass(frozen=True)
class Tables:
    database: str = "credit_card_fraud"
    transactions: str = "customer_transactions_fraud"
    customers: str = "customers"
    terminals: str = "terminals"
    features: str = "customer_trx_fraud_features"
    scored: str = "credit_card_fraud_scored"

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"


def setup(spark: SparkSession, csv_path: str, t: Tables = Tables()) -> DataFrame:
    """Namespace, typed table (created or replaced), COPY of the staged CSV, the two
    dimensions. Running it again gives the same tables."""
    create_namespace(spark, t.database)
    create_transaction_table(spark, t.name(t.transactions))
    copy_into(spark, csv_path, t.name(t.transactions))
    tx = spark.table(t.name(t.transactions))
    save_table(dimension(tx, "customer_id"), t.name(t.customers))
    save_table(dimension(tx, "terminal_id"), t.name(t.terminals))
    return spark.table(t.name(t.transactions))


def analyse(spark: SparkSession, query: str, t: Tables = Tables()) -> DataFrame:
    """One of the analysis queries by name (``analysis.<query>``) on the loaded table."""
    return getattr(analysis, query)(load_transactions(spark, t.name(t.transactions)))


def feature_engineering(
    spark: SparkSession, t: Tables = Tables(), opts: features.FeatureOptions = features.DEFAULT
) -> DataFrame:
    """Build the 23-column feature table and save it, partitioned by TX_TIME_DAYS."""
    tx = load_transactions(spark, t.name(t.transactions))
    features.save_feature_table(features.feature_table(tx, opts), t.name(t.features))
    return spark.table(t.name(t.features))


@dataclass(frozen=True)
class MLResult:
    train: DataFrame
    test: DataFrame
    scored: DataFrame
    predicted_fraud: DataFrame


def machine_learning(
    spark: SparkSession,
    t: Tables = Tables(),
    split_opts: split.SplitOptions = split.SplitOptions(),
    model_opts: models.ModelOptions = models.ModelOptions(),
    registry_path: str | None = None,
    model_version: str = "v1",
) -> MLResult:
    """Split, fit both models, save the scored test set, register the logistic model and
    score the test set with the registered version."""
    name = "logistic_fraud_detection"
    registry = ModelRegistry.create(spark, registry_path)
    registry.refuse_existing(name, model_version)  # before anything is trained or overwritten
    feats = spark.table(t.name(t.features))
    unsorted = split.SplitOptions(**{**split_opts.__dict__, "sort": False})
    train, test = split.train_split(feats, unsorted), split.test_split(feats, unsorted)
    fitted = models.fit_all(train, model_opts)
    models.save_scored(models.score_both(fitted.lm, fitted.rf, test), t.name(t.scored))
    params = {"maxIter": model_opts.lr_max_iter}
    ref = registry.log_model(name, model_version, fitted.lm, params, fitted.rows)
    return MLResult(
        train=split.train_split(feats, split_opts),
        test=split.test_split(feats, split_opts),
        scored=spark.table(t.name(t.scored)),
        predicted_fraud=assessment.predicted_fraud(ref.predict(test)),
    )


def model_assessment(spark: SparkSession, t: Tables = Tables()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Confusion matrices and metrics of both models, and the scored actual frauds."""
    scored = spark.table(t.name(t.scored))
    return (
        assessment.confusion_matrix(scored),
        assessment.classification_metrics(scored),
        assessment.actual_fraud_rows(scored),
    )
