"""Column expressions shared by all plans. All of them are built-in Spark expressions, so
they stay inside whole-stage codegen; none needs a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def weekend_flag(ts: str | Column) -> Column:
    """1 on Saturday and Sunday, else 0 (Spark numbers Sunday 1 .. Saturday 7)."""
    return F.when(F.dayofweek(_c(ts)).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def night_flag(ts: str | Column) -> Column:
    """1 from 21:00 to 05:59, else 0."""
    hour = F.hour(_c(ts))
    return F.when((hour < 6) | (hour > 20), F.lit(1)).otherwise(F.lit(0))


# Amounts are DOUBLE without a fixed scale. What fits this type without loss is summed in
# it, exactly and in any order; everything else is summed as DOUBLE.
EXACT_TYPE = "decimal(28,6)"


def exact_part(amount: str | Column) -> Column:
    """The amount as a decimal if that loses nothing, else NULL."""
    d = _c(amount).try_cast(EXACT_TYPE)
    return F.when(d.cast("double") == _c(amount), d)


def rest_part(amount: str | Column) -> Column:
    """The amount if it does not fit the decimal (finer digits, huge values, NaN), else NULL."""
    x = _c(amount)
    return F.when(x.isNotNull() & exact_part(x).isNull(), x)


def total(exact_sum: str | Column, rest_sum: str | Column) -> Column:
    """The two partial sums as one DOUBLE; NULL if both are."""
    exact, rest = _c(exact_sum).cast("double"), _c(rest_sum)
    return F.when(rest.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + rest)


def amount_total(amount: str | Column) -> Column:
    """SUM of a DOUBLE column: every digit counts, and totals of amounts with up to six
    decimals do not depend on how partitions are merged."""
    return total(F.sum(exact_part(amount)), F.sum(rest_part(amount)))


def round_half_away(x: str | Column) -> Column:
    """DOUBLE -> BIGINT rounding half away from zero (the reference's cast), without the
    BigDecimal detour of ``F.round``; NULL for NaN and beyond BIGINT."""
    c = _c(x)
    away = F.floor(F.abs(c) + F.lit(0.5))
    return F.when(~F.isnan(c) & (F.abs(c) < 9.2e18), F.when(c < 0, -away).otherwise(away))


def day_number(ts: str | Column) -> Column:
    """Days since 1970-01-01 of the calendar date of a timestamp (INT)."""
    return F.unix_date(F.to_date(_c(ts)))
