"""Trailing sums over calendar days on a per-(key, day) table.

A frame "days d-a .. d-b" is a RANGE frame on the integer day number: days without rows
add nothing, exactly as the zero rows of a dense key x day grid would, so no grid is
built. The window runs over *pre-aggregated* daily rows: one partition holds at most one
row per calendar day of one key, whatever the number of transactions behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_frames(key: str, day: str, frames: dict[str, tuple[str, int, int]]) -> dict[str, Column]:
    """``frames``: output name -> (column, start, end), offsets in days relative to the
    row's day (negative = earlier). The result is NULL when the frame holds no row."""
    base = Window.partitionBy(key).orderBy(day)
    return {
        name: F.sum(col).over(base.rangeBetween(lo, hi))
        for name, (col, lo, hi) in frames.items()
    }


def trailing(daily: DataFrame, key: str, day: str, frames: dict[str, tuple[str, int, int]]) -> DataFrame:
    return daily.select(key, day, *[c.alias(n) for n, c in day_frames(key, day, frames).items()])


def trailing_behind_running(
    run: DataFrame, key: str, day: str, ts: str, frames: dict[str, tuple[str, int, int]]
) -> DataFrame:
    """``run`` (one row per key and timestamp, with totals so far that day) plus the frames over
    the days' totals, the same for every row of a day. All windows need the key's rows together
    and nothing else, so one shuffle by the key serves them.

    A day's last row holds its totals. These rows form one partition per key, with a row per day
    as in ``trailing``; each other row is one of its own, so that no frame holds more than days.
    """
    in_day = Window.partitionBy(key, day).orderBy(ts)
    marked = run.withColumn("_others", F.when(F.lead(ts).over(in_day).isNotNull(), F.col(ts)))
    days = Window.partitionBy(key, "_others").orderBy(day)
    sums = [F.sum(col).over(days.rangeBetween(lo, hi)).alias(n) for n, (col, lo, hi) in frames.items()]
    ended = marked.withColumn("_sums", F.struct(*sums))
    whole = in_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spread = ended.withColumn("_sums", F.last("_sums").over(whole))
    return spread.select(*run.columns, "_sums.*")
