"""Namespace, typed table creation, dimensions and table writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txengine.sources.schema import LOADED_FROM, TX_SCHEMA


def create_namespace(spark: SparkSession, database: str) -> None:
    """Database + schema of the reference fold to one Spark database. Never dropped."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def create_transaction_table(spark: SparkSession, table: str) -> None:
    """Create or replace: an empty managed table with the declared 9 columns and ``LOADED_FROM``,
    which says what file a row was loaded from. Nothing is remembered of earlier loads."""
    schema = T.StructType([*TX_SCHEMA.fields, T.StructField(LOADED_FROM, T.StringType(), True)])
    spark.createDataFrame([], schema).write.mode("overwrite").saveAsTable(table)


def dimension(tx: DataFrame, key: str) -> DataFrame:
    """Distinct values of one key, sorted (NULL kept, as SELECT DISTINCT does). Map-side partial aggregation makes the shuffle carry one row per key
    per task."""
    return tx.select(key).distinct().orderBy(F.col(key).asc_nulls_first())


def save_table(df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
