"""Model training and chained batch scoring (the reference's training step), on Spark ML.

Parameter mapping from the reference's estimators (library defaults documented publicly):
  logistic regression: L2 penalty with C = 1 on the summed loss, unscaled inputs,
      stopping tolerance 1e-4
      -> ``regParam = 1 / n``, ``elasticNetParam = 0``, ``standardization = False``,
         ``tol = 1e-4``, ``maxIter = 1000``;
  random forest: 100 trees, Gini, sqrt(features) per split, bootstrap
      -> ``numTrees = 100``, ``impurity = "gini"``, ``featureSubsetStrategy = "sqrt"``;
         the reference grows unbounded trees; ``maxDepth = 30`` is the deepest Spark allows.
         Spark ML holds the whole forest on the driver, so where rows x trees exceed
         ``DRIVER_FOREST`` the same kind of forest is grown by ``forest.grow`` instead.

Both fits read a training set that is written once to the shared folder first, so the
feature plan runs once and the iterations read Parquet, not the lineage.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txengine.operators.joins import materialize
from txengine.plans import forest
from txengine.sources.schema import LABEL, MODEL_FEATURES

#: Rows x trees whose forest Spark ML may hold on the driver.
DRIVER_FOREST = 4_000_000


@dataclass(frozen=True)
class ModelOptions:
    features: tuple[str, ...] = tuple(MODEL_FEATURES)
    label: str = LABEL
    handle_invalid: str = "error"  # rows with NULL inputs (first calendar day) raise; "skip" drops
    lr_max_iter: int = 1000
    lr_tol: float = 1e-4
    lr_standardization: bool = False
    rf_trees: int = 100
    rf_max_depth: int = 30
    seed: int = 42


def _assembler(opts: ModelOptions, suffix: str) -> VectorAssembler:
    return VectorAssembler(
        inputCols=list(opts.features), outputCol=f"features_{suffix}", handleInvalid=opts.handle_invalid
    )


def _training_frame(train: DataFrame, opts: ModelOptions) -> tuple[DataFrame, int]:
    """The written training set and its rows; rows that the models would skip are not in it."""
    cols = list(dict.fromkeys([*opts.features, opts.label]))
    df = train.select(*cols).withColumn(opts.label, F.col(opts.label).cast("double"))
    if opts.handle_invalid == "skip":
        df = df.dropna(subset=list(opts.features))
    data = materialize(train.sparkSession, df, "train_set")
    return data, data.count()


def fit_logistic(train: DataFrame, opts: ModelOptions = ModelOptions()) -> PipelineModel:
    data, n = _training_frame(train, opts)
    return fit_logistic_on(data, n, opts)


def fit_forest(train: DataFrame, opts: ModelOptions = ModelOptions()) -> PipelineModel:
    data, n = _training_frame(train, opts)
    return fit_forest_on(data, n, opts)


class Fitted(NamedTuple):
    lm: PipelineModel
    rf: PipelineModel
    rows: int  # training rows


def fit_logistic_counted(train: DataFrame, opts: ModelOptions = ModelOptions()) -> tuple[PipelineModel, int]:
    """The logistic model alone, and its training rows: the driver holds its coefficients only,
    whatever the size of the training set."""
    from pyspark import StorageLevel

    data, n = _training_frame(train, opts)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit_logistic_on(data, n, opts), n
    finally:
        data.unpersist()


def fit_all(train: DataFrame, opts: ModelOptions = ModelOptions(), lm: PipelineModel | None = None) -> Fitted:
    """Write the training set once, keep it in executor memory (spilling to disk) for the
    iterations of both fits, release it after. The two fits are independent Spark jobs
    and are submitted from two driver threads, so that one fit's many small iteration
    jobs fill the slots the other leaves idle. ``lm``: the logistic model, if it is fitted already."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import StorageLevel

    data, n = _training_frame(train, opts)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(max_workers=2) as pool:
            logistic = None if lm else pool.submit(fit_logistic_on, data, n, opts)
            rf = pool.submit(fit_forest_on, data, n, opts)
            return Fitted(lm or logistic.result(), rf.result(), n)
    finally:
        data.unpersist()


def fit_both(train: DataFrame, opts: ModelOptions = ModelOptions()) -> tuple[PipelineModel, PipelineModel]:
    fitted = fit_all(train, opts)
    return fitted.lm, fitted.rf


def fit_logistic_on(data: DataFrame, n: int, opts: ModelOptions) -> PipelineModel:
    lr = LogisticRegression(
        featuresCol="features_lm", labelCol=opts.label, predictionCol="prediction_lm",
        rawPredictionCol="raw_lm", probabilityCol="probability_lm",
        maxIter=opts.lr_max_iter, tol=opts.lr_tol, regParam=1.0 / max(n, 1),
        elasticNetParam=0.0, standardization=opts.lr_standardization,
    )
    return Pipeline(stages=[_assembler(opts, "lm"), lr]).fit(data)


def fit_forest_on(data: DataFrame, n: int, opts: ModelOptions) -> PipelineModel:
    if n * opts.rf_trees > DRIVER_FOREST:
        return grow_forest_on(data, n, opts)
    rf = RandomForestClassifier(
        featuresCol="features_rf", labelCol=opts.label, predictionCol="prediction_rf",
        rawPredictionCol="raw_rf", probabilityCol="probability_rf",
        numTrees=opts.rf_trees, maxDepth=opts.rf_max_depth, impurity="gini",
        featureSubsetStrategy="sqrt", seed=opts.seed,
    )
    return Pipeline(stages=[_assembler(opts, "rf"), rf]).fit(data)


def grow_forest_on(data: DataFrame, n: int, opts: ModelOptions) -> PipelineModel:
    """The forest by Spark jobs that keep its trees in the shared folder."""
    assembler, label = _assembler(opts, "rf"), F.col(opts.label)
    known = F.when(label.isin(0.0, 1.0), label).otherwise(F.raise_error(F.lit("labels must be 0 or 1")))
    rows = assembler.transform(data).select(vector_to_array("features_rf").alias("x"), known.cast("int").alias("y"))
    path, points = forest.grow(rows, len(opts.features), n, opts.rf_trees, opts.rf_max_depth, opts.seed)
    columns = {"features": "features_rf", "prediction": "prediction_rf", "raw": "raw_rf", "probability": "probability_rf"}
    return PipelineModel([assembler, forest.GrownForest(path, points, opts.rf_trees, opts.rf_max_depth, columns)])


def _finish(df: DataFrame, suffix: str) -> DataFrame:
    """Prediction as INT label (what the reference stores, D13) plus the fraud probability
    as an extra column; vector columns dropped."""
    return df.withColumns(
        {
            f"prediction_{suffix}": F.col(f"prediction_{suffix}").cast("int"),
            f"fraud_probability_{suffix}": vector_to_array(f"probability_{suffix}")[1],
        }
    ).drop(f"features_{suffix}", f"raw_{suffix}", f"probability_{suffix}")


def score_logistic(model: PipelineModel, df: DataFrame) -> DataFrame:
    return _finish(model.transform(df), "lm")


def score_forest(model: PipelineModel, df: DataFrame) -> DataFrame:
    return _finish(model.transform(df), "rf")


def score_both(lm: PipelineModel, rf: PipelineModel, df: DataFrame) -> DataFrame:
    """rf.predict(lm.predict(df)): both models applied row by row in one narrow pass (no
    shuffle); the models are broadcast with the task closures. A grown forest's trees are joined
    to the rows instead (``forest.GrownForest``)."""
    return score_forest(rf, score_logistic(lm, df))


def save_scored(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)
