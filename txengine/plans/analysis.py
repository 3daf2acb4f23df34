"""The reference's analysis worksheet queries (SQL and DataFrame), as DataFrame plans.

Amounts of up to six decimals are summed exactly, so results do not depend on partitioning or
merge order; all others are summed as DOUBLE (``functions.columns``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txengine.functions.columns import EXACT_TYPE, amount_total, exact_part, round_half_away, total
from txengine.sources.catalog import dimension
from txengine.sources.schema import TX_COLUMNS


def _total(col: str = "tx_amount"):
    return amount_total(col)


def _mean(col: str = "tx_amount"):
    return F.try_divide(_total(col), F.count(col))


def tx_scan(tx: DataFrame) -> DataFrame:
    """SELECT * FROM transactions."""
    return tx.select("*")


def tx_count(tx: DataFrame) -> DataFrame:
    return tx.agg(F.count(F.lit(1)).alias("total_rows"))


def amount_summary(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.min("tx_amount").alias("min_amount"),
        F.max("tx_amount").alias("max_amount"),
        _mean().alias("avg_amount"),
        _total().alias("total_amount"),
    )


def amount_by_scenario(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy("tx_fraud_scenario")
        .agg(_total().alias("total_amount"))
        .orderBy("tx_fraud_scenario")
    )


def avg_by_scenario(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy("tx_fraud_scenario")
        .agg(_mean().alias("avg_amount"))
        .orderBy(F.desc("avg_amount"))
    )


def top_spenders(tx: DataFrame, k: int = 10) -> DataFrame:
    """Top-k customers by spend and their share of the total.

    The share's denominator sums amounts first rounded to whole units (half away from
    zero), as the reference does; it is an uncorrelated scalar subquery, run once. The
    sort + limit plans as TakeOrderedAndProject: each task keeps its own top k, only
    k rows per task reach the final merge. Ties on spend are broken by customer id. A zero
    denominator gives a NULL share.
    """
    denominator = tx.select(F.sum(round_half_away("tx_amount"))).scalar()
    spend = tx.groupBy("customer_id").agg(_total().alias("total_spend"))
    return (
        spend.select(
            "customer_id",
            "total_spend",
            F.round(F.try_divide(F.col("total_spend") * 1.0, denominator) * 100, 2).alias(
                "percentage_contribution"
            ),
        )
        .orderBy(F.desc("total_spend"), F.asc("customer_id"))
        .limit(k)
    )


NUMERIC_COLUMNS = [c for c in TX_COLUMNS if c != "tx_datetime"]


def numeric_describe(tx: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Typed ``describe()``: one row per numeric column with count, mean, sample standard
    deviation, min and max as numbers (Spark's ``describe`` returns strings). One pass; every
    value becomes a row of its column before tasks add up, so one set of sums serves all columns.

    Sums and sums of squares are exact decimals, so no digit depends on how partitions are
    merged. Only columns with values that no decimal of 18 digits holds (beyond 10^12 or finer than
    10^-6) take Spark's own deviation, whose last digits do depend on it."""
    cols = columns or NUMERIC_COLUMNS
    kinds = dict(tx.dtypes)
    exact = {c: exact_part(c) if kinds[c] in ("double", "float") else F.col(c).cast(EXACT_TYPE) for c in cols}
    parts = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x"), exact[c].alias("exact")) for c in cols)
    )
    # a column without rows has a row of its own
    names = tx.sparkSession.range(1).select(F.inline(F.array(*(F.struct(F.lit(c).alias("column_name")) for c in cols))))
    none = names.select("column_name", F.lit(None).cast("double").alias("x"), F.lit(None).cast(EXACT_TYPE).alias("exact"))
    short = F.col("exact").try_cast("decimal(18,6)")
    sums = tx.select(F.inline(parts)).unionAll(none).groupBy("column_name").agg(
        F.count("x").alias("n"),
        F.sum("exact").alias("exact"),
        F.sum(F.when(F.col("exact").isNull(), F.col("x"))).alias("rest"),
        F.count(F.when(short == F.col("exact"), 1)).alias("n_short"),
        F.try_sum(short * short).alias("squares"),
        F.stddev_samp("x").alias("merged"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    n, s = F.col("n"), F.col("exact").cast("double")
    spread = F.col("squares").cast("double") - F.try_divide(s * s, n)
    own = F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), n - 1))
    stddev = F.when(n < 2, F.lit(None)).when((F.col("n_short") == n) & F.col("squares").isNotNull(), own)
    return sums.select(
        "column_name", n.alias("count"),
        F.try_divide(total("exact", "rest"), n).alias("mean"),
        stddev.otherwise(F.col("merged")).alias("stddev"),
        "min", "max",
    )


def tx_by_day(tx: DataFrame) -> DataFrame:
    """Transactions per calendar day."""
    return (
        tx.groupBy(F.to_date("tx_datetime").alias("date"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("date")
    )


def fraud_share(tx: DataFrame) -> DataFrame:
    """Count per label and its percentage of all counted rows (ratio to report).

    The window without partition runs after the group-by, over one row per label value,
    so its single partition holds a handful of rows whatever the table size.
    """
    counts = tx.groupBy("tx_fraud").agg(F.count("transaction_id").alias("nb_tx_day"))
    whole = Window.partitionBy()
    return counts.select(
        "tx_fraud",
        "nb_tx_day",
        (F.try_divide(F.col("nb_tx_day"), F.sum("nb_tx_day").over(whole)) * 100).alias(
            "percentage"
        ),
    )


def fraud_by_customer(tx: DataFrame) -> DataFrame:
    return (
        tx.filter(F.col("tx_fraud") == 1)
        .groupBy("customer_id")
        .agg(F.sum("tx_fraud").alias("nbr_fraud_trx"))
    )


def distinct_customers(tx: DataFrame) -> DataFrame:
    return dimension(tx, "customer_id")


def distinct_terminals(tx: DataFrame) -> DataFrame:
    return dimension(tx, "terminal_id")
