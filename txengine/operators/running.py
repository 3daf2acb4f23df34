"""Running totals "so far today" per key, with RANGE semantics: rows with an equal timestamp
are peers and see each other.

No window ever sees raw rows. They are first added up per (key, timestamp), before the shuffle
as far as tasks can -- peers share one value, which is what RANGE means. One window per key and
day then runs over the distinct timestamps, as a stream of totals that can spill. The result
goes back to the untouched rows by an equi-join on (key, timestamp), which Spark can split where
a key is hot. The rows themselves are moved once, for that join, or not at all where the totals
are small enough to be sent to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txengine.functions.columns import day_number

DAY = "_day"


def running_per_timestamp(per_ts: DataFrame, key: str, ts: str, sums: list[str]) -> DataFrame:
    """``per_ts`` (one row per key and timestamp, with partial sums) with ``run_<sum>`` for
    each: its total over the key's rows of the same day up to this timestamp."""
    upto = Window.partitionBy(key, DAY).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    keyed = per_ts.withColumn(DAY, day_number(ts))
    return keyed.select("*", *(F.sum(c).over(upto).alias(f"run_{c}") for c in sums))


def running_today(rows: DataFrame, key: str, ts: str, sums: dict[str, Column]) -> DataFrame:
    """``rows`` with one column per entry of ``sums`` (name -> aggregate that adds up): its
    total over the rows of the same key and day with a timestamp up to this row's. ``rows``
    must not hold NULL keys or timestamps."""
    per_ts = rows.groupBy(key, ts).agg(*(c.alias(n) for n, c in sums.items()))
    run = running_per_timestamp(per_ts, key, ts, list(sums))
    return rows.join(run.select(key, ts, *(F.col(f"run_{n}").alias(n) for n in sums)), [key, ts])
