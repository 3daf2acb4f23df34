"""Fitted models checked by plain DataFrame jobs: the logistic fit by its gradient, both models'
predictions by scoring them again from their stored numbers.

A forest is exported as a node table, one row per (tree, node). To score by it, chunks of rows are
crossed with the trees, each an array of its nodes, and every row walks down each tree in SQL: from
its node to the child that the row's feature chooses, one step per level of the deepest tree. Rows
and trees meet once, whatever the depth; neither is held whole by a task or the driver.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txengine.operators.joins import materialize
from txengine.plans.forest import GrownForest
from txengine.plans.models import ModelOptions
from txengine.session import scratch_path

#: Largest gradient, per standard deviation of the feature, that still counts as the optimum.
TOLERANCE = 2e-4


def margin(model: PipelineModel, opts: ModelOptions = ModelOptions()) -> Column:
    """The log-odds that the stored coefficients give a row."""
    lr = model.stages[-1]
    out = F.lit(float(lr.intercept))
    for name, w in zip(opts.features, lr.coefficients.toArray().tolist()):
        out = out + F.lit(w) * F.col(name).cast("double")
    return out


def logistic_gradient(model: PipelineModel, train: DataFrame, opts: ModelOptions = ModelOptions()) -> DataFrame:
    """(coefficient, value, gradient, at_optimum): of the penalised mean loss at the stored
    coefficients, per standard deviation of the feature, from one pass over the training rows.
    A constant feature is measured in its own unit; the intercept is not penalised."""
    lr = model.stages[-1]
    weights = lr.coefficients.toArray().tolist()
    off = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(model, opts))) - F.col(opts.label).cast("double")
    rows = train.select(off.alias("off"), *(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(opts.features)))
    aggs = [F.avg("off").alias("base")]
    for i in range(len(weights)):
        aggs += [F.avg(F.col("off") * F.col(f"x{i}")).alias(f"g{i}"), F.stddev_pop(f"x{i}").alias(f"s{i}")]
    one = rows.agg(*aggs)
    parts = []
    for i, (name, w) in enumerate(zip(opts.features, weights)):
        wide = F.when(F.col(f"s{i}") > 0, F.col(f"s{i}")).otherwise(F.lit(1.0))
        parts.append((name, w, (F.col(f"g{i}") + F.lit(lr.getRegParam() * w)) / wide))
    parts.append(("intercept", float(lr.intercept), F.col("base")))
    structs = [
        F.struct(F.lit(n).alias("coefficient"), F.lit(w).alias("value"), g.alias("gradient"), (F.abs(g) <= TOLERANCE).alias("at_optimum"))
        for n, w, g in parts
    ]
    return one.select(F.inline(F.array(*structs)))


# ------------------------------------------------------------------------------- forest
def forest_nodes(model: PipelineModel, spark) -> DataFrame:
    """(tree, node, feature, threshold, left_child, right_child, fraud): a row goes to
    ``left_child`` if its feature is at most the threshold; a leaf has no children. ``fraud``:
    the leaf's share of label 1."""
    if isinstance(model.stages[-1], GrownForest):
        return model.stages[-1].nodes()
    path = scratch_path(spark, "forest")
    model.stages[-1].write().save(path)
    data = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    if data.where("split.numCategories > 0").limit(1).count():
        raise ValueError("the node table knows numeric features only")
    inner = F.col("leftChild") >= 0
    stats = F.col("impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    return data.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left_child"), F.when(inner, F.col("rightChild")).alias("right_child"),
        F.when(~inner, F.when(total > 0, stats[1] / total).otherwise(0.0)).alias("fraud"),
    )


def table_scores(
    nodes: DataFrame, trees: int, depth: int, rows: DataFrame, id_col: str, opts: ModelOptions = ModelOptions()
) -> DataFrame:
    """(id_col, table_probability, table_prediction) from the node table: the mean over all
    ``trees`` of the leaf's share. ``depth`` of the deepest tree; ``id_col`` tells the rows apart;
    a tree's nodes are numbered from 0 without gaps."""
    spark = rows.sparkSession
    features = F.array(*(F.col(c).cast("double") for c in opts.features))
    one = rows.select(F.shiftright(F.monotonically_increasing_id(), 12).alias("chunk"), F.struct(F.col(id_col).alias("id"), features.alias("x")).alias("row"))
    chunks = materialize(spark, one.groupBy("chunk").agg(F.collect_list("row").alias("rows")), "forest_check_rows")
    # a leaf is its own child: rows that have come to one stay
    own = {"feature": F.lit(0), "threshold": F.lit(0.0), "left_child": F.col("node"), "right_child": F.col("node")}
    node = F.struct("node", *(F.coalesce(F.col(c), other).alias(c) for c, other in own.items()), "fraud")
    walked = nodes.where(F.col("tree") < trees).groupBy("tree").agg(F.array_sort(F.collect_list(node)).alias("at"))
    tables = materialize(spark, walked, "forest_check_trees")

    def leaf(x: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            n = F.col("at")[node]
            return F.when(x[n["feature"]] <= n["threshold"], n["left_child"]).otherwise(n["right_child"])

        return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(0), step)

    stands = F.transform("rows", lambda r: F.struct(r["id"].alias(id_col), F.col("at")[leaf(r["x"])]["fraud"].alias("fraud")))
    each = chunks.crossJoin(tables.select("at")).select(F.inline(stands))
    mean = each.groupBy(id_col).agg(F.avg("fraud").alias("table_probability"))
    return mean.withColumn("table_prediction", F.when(F.col("table_probability") > 0.5, 1).otherwise(0))


def forest_differences(model: PipelineModel, scored: DataFrame, id_col: str, opts: ModelOptions = ModelOptions()) -> DataFrame:
    """(rows, different): scored rows, and those where the node table gives another prediction,
    or a probability that is off by more than rounding."""
    forest = model.stages[-1]
    depth = max(t.depth for t in forest.trees)
    again = table_scores(forest_nodes(model, scored.sparkSession), forest.getNumTrees, depth, scored, id_col, opts)
    both = scored.select(id_col, "prediction_rf", "fraud_probability_rf").join(again, id_col, "left")
    same = (F.col("prediction_rf") == F.col("table_prediction")) & (
        F.abs(F.col("fraud_probability_rf") - F.col("table_probability")) < 1e-9
    )
    return _differences(both, same)


def logistic_differences(model: PipelineModel, scored: DataFrame, opts: ModelOptions = ModelOptions()) -> DataFrame:
    """(rows, different): scored rows, and those that the stored coefficients flag otherwise."""
    same = (F.col("prediction_lm") == 1) == (margin(model, opts) > 0)
    return _differences(scored, same)


def _differences(rows: DataFrame, same: Column) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(same, F.lit(False))).alias("different")
    )
