"""Model assessment (the reference's last step): confusion matrices, metrics, and the
scored rows that are actual frauds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txengine.operators import classification
from txengine.sources.schema import LABEL

MODELS = {"lm": "prediction_lm", "rf": "prediction_rf"}


def confusion_matrix(scored: DataFrame) -> DataFrame:
    return classification.confusion_matrix(scored, LABEL, MODELS)


def classification_metrics(scored: DataFrame) -> DataFrame:
    return classification.classification_metrics(scored, LABEL, MODELS)


def actual_fraud_rows(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col(LABEL) == 1)


def predicted_fraud(scored: DataFrame, prediction: str = "prediction_lm") -> DataFrame:
    return scored.filter(F.col(prediction) == 1)


def rule_scored(test: DataFrame) -> DataFrame:
    """A fixed-rule stand-in for the two models, so that the assessment queries have an
    exact SQL oracle: "lm" flags amounts above 150, "rf" flags terminals with any recent
    fraud. Same columns as the model-scored table."""
    return test.withColumns(
        {
            "prediction_lm": F.when(F.col("tx_amount") > 150, 1).otherwise(0),
            "prediction_rf": F.when(F.col("term_risk_30") > 0, 1).otherwise(0),
        }
    )
