"""Side tables that are written before they are joined."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txengine.session import scratch_path


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back.

    Cuts the lineage (a lost executor re-reads the files instead of recomputing the
    aggregation) and gives the planner the exact file size, by which Spark itself decides
    whether a join with it broadcasts it.
    """
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
