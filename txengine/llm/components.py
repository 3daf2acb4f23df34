"""Connected components of a link table by alternating large and small stars.

Each round keeps the components and shortens every path to its smallest node; a set of stars
needs one round, a long chain a number that grows with the logarithm of its length. All steps
are aggregates and joins of links; no neighbourhood is ever gathered into one row, and every
round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txengine.llm.common import written


def _with_least(links: DataFrame) -> DataFrame:
    """(u, v, m): links with the smallest node next to or equal to ``u``."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return links.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (u, v); the component is its smallest
    node. Links may repeat and point either way; nodes without a link are not returned."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    now = written(down.distinct(), "links")
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _with_least(large.where("u > v").distinct())
        step = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            small.select("u", F.col("m").alias("v"))
        )
        now = written(step.distinct(), "links")
        # done when all are stars: no node has two centres, no centre has one itself
        forked = now.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
        chained = now.join(now.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")
        if forked.isEmpty() and chained.isEmpty():
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
