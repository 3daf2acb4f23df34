"""Leakage-safe transaction features (the reference's feature engineering step).

Per transaction:
  * weekend / night flags;
  * customer behaviour: count and mean amount over the previous 1 / 7 / 30 calendar days
    plus the same day up to and including this transaction's timestamp;
  * terminal risk: fraud share of the transactions of days [d-n-delay, d-delay-1], so that
    only labels old enough to be known are used.

Spark plan (no dense grid, no cross join, no window over raw rows):
  tx --> parts: what the features are made of (five columns), written once; the calendar's
         bounds come from it too
     |-- customer: one shuffle by customer of (timestamp, amount), in which the sums per distinct
     |   timestamp, their running totals (``operators.running``) and the RANGE frames over the
     |   days' totals (``operators.trailing``) follow each other --> features per (customer, timestamp)
     `-- terminal: daily label counts, RANGE frames [-(n+7), -8] over them, written
  rows of tx --> equi-join on (terminal, day) --> equi-join on (customer, timestamp)

The rows are read once more and joined untouched: peers share one value. They move with the
input columns only; what follows from these is added behind the joins, and the terminal's
columns, mostly zeros, are joined first. A hot customer's or terminal's rows can be split by
Spark's skew handling, since only joins touch them.

  D3  the calendar ends the day before the last date: that day's rows are dropped
      (``keep_last_day=False``, literal, default);
  D4  the 7-day terminal columns use the 1-day frame (``terminal_window_7="literal"``;
      default "intended": 7 days);
  D5  first calendar day: terminal counts NULL, risk 0 (kept);
  D6  customer history counts rows with amount > 0, today's count all rows (kept);
  D18 a terminal whose labels so far today are all NULL gets risk 0
      (``literal_current_day_labels=True``; default computes the risk).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txengine.functions.columns import (
    day_number,
    exact_part,
    night_flag,
    rest_part,
    total,
    weekend_flag,
)
from txengine.operators.joins import materialize
from txengine.operators.running import running_per_timestamp, running_today
from txengine.operators.trailing import trailing, trailing_behind_running
from txengine.sources.schema import (
    CUSTOMER_FEATURES,
    FEATURE_TABLE_COLUMNS,
    FLAG_COLUMNS,
    TERMINAL_FEATURES,
    TX_COLUMNS,
)

DAY = "day_no"


@dataclass(frozen=True)
class FeatureOptions:
    windows: tuple[int, ...] = (1, 7, 30)
    delay: int = 7
    keep_last_day: bool = False
    terminal_window_7: str = "intended"  # or "literal"
    literal_current_day_labels: bool = False


DEFAULT = FeatureOptions()


def reach(opts: FeatureOptions) -> int:
    """How many days before a day its features look at."""
    return max(opts.windows) + opts.delay


def date_time_features(tx: DataFrame) -> DataFrame:
    """The 9 input columns + TX_DURING_WEEKEND, TX_DURING_NIGHT."""
    return tx.withColumns(
        {
            "tx_during_weekend": weekend_flag("tx_datetime"),
            "tx_during_night": night_flag("tx_datetime"),
        }
    )


# --------------------------------------------------------------------------------- parts
def transaction_parts(tx: DataFrame, stored: bool = False) -> DataFrame:
    """What the features are made of: both keys, timestamp, amount and label of every row with a
    timestamp (others match no calendar day). NULL keys are kept, for the calendar. Written, unless
    ``tx`` is ``stored``: a written table, which is as cheap to read."""
    parts = tx.where(F.col("tx_datetime").isNotNull()).select(
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("terminal_id").cast("bigint").alias("terminal_id"),
        "tx_datetime", "tx_amount", "tx_fraud",
    )
    return parts if stored else materialize(tx.sparkSession, parts, "transaction_parts")


def calendar_bounds(rows: DataFrame) -> tuple[Column, Column]:
    """First and last day number of the table, as one scalar subquery (run once)."""
    d = day_number("tx_datetime")
    b = rows.select(F.struct(F.min(d).alias("lo"), F.max(d).alias("hi"))).scalar()
    return b.getField("lo"), b.getField("hi")


@dataclass(frozen=True)
class _Inputs:
    """Rows and their parts restricted to the calendar (D3), and its first day."""

    rows: DataFrame
    parts: DataFrame
    first: Column


def _since(first: Column, offset: int) -> Column:
    """Midnight ``offset`` days after a day number, to compare timestamps with (pushed down)."""
    return F.date_from_unix_date((first + F.lit(offset)).cast("int")).cast("timestamp_ntz")


def _inputs(
    tx: DataFrame, opts: FeatureOptions, days: tuple[int, int | None] | None = None, stored: bool = False
) -> _Inputs:
    """``days``: first and last day, counted from the calendar's first, whose rows are wanted; only
    the transactions that these days' windows reach are read for the parts."""
    if days is None:
        parts = transaction_parts(tx, stored)
        first, last = calendar_bounds(parts)
        wanted = tx
    else:
        first, last = calendar_bounds(tx)
        ts = F.col("tx_datetime")
        until = tx if days[1] is None else tx.where(ts < _since(first, days[1] + 1))
        parts = transaction_parts(until.where(ts >= _since(first, days[0] - reach(opts))), stored)
        wanted = until.where(ts >= _since(first, days[0]))
    d = day_number("tx_datetime")
    inside = d <= last if opts.keep_last_day else d < last
    columns = [c for c in TX_COLUMNS if c in tx.columns]
    return _Inputs(wanted.select(*columns).where(inside), parts.where(inside), first)


# ----------------------------------------------------------------------------- customer
def _per_timestamp(parts: DataFrame, opts: FeatureOptions) -> DataFrame:
    """(customer, timestamp) -> CUST_CNT_TX_n, CUST_AVG_AMOUNT_n: the n days before, plus the
    same day up to the timestamp. A customer's amounts are brought together once; sums, running
    totals and frames need no other shuffle."""
    key, amount = "customer_id", F.col("tx_amount")
    of_customer = parts.where(F.col(key).isNotNull()).select(key, "tx_datetime", "tx_amount").repartition(key)
    per_ts = of_customer.groupBy(key, "tx_datetime").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(amount > 0).alias("n_pos"),
        F.sum(exact_part(amount)).alias("exact"),
        F.sum(rest_part(amount)).alias("rest"),
    )
    run = running_per_timestamp(per_ts, key, "tx_datetime", ["n", "n_pos", "exact", "rest"])
    frames = {f"_{c}_{n}": (f"run_{c}", -n, -1) for n in opts.windows for c in ("n_pos", "exact", "rest")}
    both = trailing_behind_running(run, key, "_day", "tx_datetime", frames)
    today = total("run_exact", "run_rest")
    feats = []
    for n in opts.windows:
        count = F.coalesce(F.col(f"_n_pos_{n}"), F.lit(0)) + F.col("run_n")
        exact = F.coalesce(F.col(f"_exact_{n}"), F.lit(0).cast("decimal(28,6)")) + F.col("run_exact")
        # one sum of all exact parts, unless today has none
        amount = F.when(F.col("run_exact").isNotNull(), exact.cast("double")).otherwise(
            F.coalesce(F.col(f"_exact_{n}").cast("double"), F.lit(0.0))
        ) + F.coalesce(F.col(f"_rest_{n}"), F.lit(0.0)) + F.coalesce("run_rest", F.lit(0.0))
        feats += [
            count.alias(f"cust_cnt_tx_{n}"),
            F.when(today.isNotNull(), amount / count).alias(f"cust_avg_amount_{n}"),
        ]
    return both.select(key, "tx_datetime", *feats)


def _attach_customer(rows: DataFrame, x: _Inputs, opts: FeatureOptions) -> DataFrame:
    """Rows with a customer, plus the customer features of their timestamp."""
    return rows.join(_per_timestamp(x.parts, opts), ["customer_id", "tx_datetime"])


def customer_features(tx: DataFrame, opts: FeatureOptions = DEFAULT) -> DataFrame:
    x = _inputs(tx, opts)
    out = date_time_features(_attach_customer(x.rows, x, opts))
    return out.select(*TX_COLUMNS, *FLAG_COLUMNS, *_names(CUSTOMER_FEATURES, opts))


# ----------------------------------------------------------------------------- terminal
def terminal_risk_daily(daily: DataFrame, key: str, first: Column, opts: FeatureOptions) -> DataFrame:
    """(terminal, day) -> NB_TX_WINDOW_n, TERM_RISK_n.

    The reference adds the running count of today to both the n+delay window and the delay
    window and subtracts them; the difference is the sum over days [d-n-delay, d-delay-1],
    one RANGE frame per n (R2). On the first calendar day both windows are empty: counts
    NULL and risk 0, as there.
    """
    frames = {}
    for n in opts.windows:
        span = 1 if (n == 7 and opts.terminal_window_7 == "literal") else n
        lo, hi = -(span + opts.delay), -(opts.delay + 1)
        frames[f"_tx_{n}"] = ("no_trx", lo, hi)
        frames[f"_fr_{n}"] = ("nb_fraud", lo, hi)
    t = trailing(daily, key, DAY, frames)
    started = F.col(DAY) > first
    cols = {}
    for n in opts.windows:
        nb = F.when(started, F.coalesce(F.col(f"_tx_{n}"), F.lit(0)))
        fr = F.when(started, F.coalesce(F.col(f"_fr_{n}"), F.lit(0)))
        cols[f"nb_tx_window_{n}"] = nb
        cols[f"term_risk_{n}"] = F.when(fr > 0, fr / nb).otherwise(F.lit(0.0)).cast("double")
    return t.select(key, DAY, *[c.alias(k) for k, c in cols.items()])


def _attach_terminal(fact: DataFrame, x: _Inputs, opts: FeatureOptions) -> DataFrame:
    label = F.col("tx_fraud")
    daily = (
        x.parts.where(F.col("terminal_id").isNotNull())
        .groupBy(F.col("terminal_id").alias("_terminal"), day_number("tx_datetime").alias(DAY))
        .agg(F.count(label).alias("no_trx"), F.sum(F.coalesce(label, F.lit(0))).alias("nb_fraud"))
    )
    risk = materialize(fact.sparkSession, terminal_risk_daily(daily, "_terminal", x.first, opts), "terminal_risk")
    same = (F.col("terminal_id") == F.col("_terminal")) & (day_number("tx_datetime") == F.col(DAY))
    out = fact.join(risk, same).drop("_terminal", DAY)
    if opts.literal_current_day_labels:
        # D18: the reference's risk is 0 when today's running fraud sum on the terminal (up
        # to this timestamp) is NULL, i.e. every label so far today is NULL.
        out = running_today(out, "terminal_id", "tx_datetime", {"_cur_fraud": F.sum("tx_fraud")})
        out = out.withColumns(
            {
                f"term_risk_{n}": F.when(F.col("_cur_fraud").isNull(), F.lit(0.0)).otherwise(
                    F.col(f"term_risk_{n}")
                )
                for n in opts.windows
            }
        ).drop("_cur_fraud")
    return out


def terminal_features(tx: DataFrame, opts: FeatureOptions = DEFAULT) -> DataFrame:
    x = _inputs(tx, opts)
    fact = x.rows.select("transaction_id", "terminal_id", "tx_datetime", "tx_fraud")
    out = _attach_terminal(fact, x, opts)
    return out.select("transaction_id", "terminal_id", "tx_datetime", *_names(TERMINAL_FEATURES, opts))


# ----------------------------------------------------------------------------- table
def feature_table(
    tx: DataFrame,
    opts: FeatureOptions = DEFAULT,
    days: tuple[int, int | None] | None = None,
    stored: bool = False,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The 23-column feature table (9 input columns, 2 flags, 6 customer, 6 terminal), of the days
    from ``days[0]`` to ``days[1]`` (None: the last) if given, counted as TX_TIME_DAYS are.
    ``stored``: ``tx`` is a written table. ``derive`` adds the input columns that ``tx`` lacks and
    that follow from the others, behind the joins, so that they are not moved."""
    x = _inputs(tx, opts, days, stored)
    out = date_time_features(_attach_customer(_attach_terminal(x.rows, x, opts), x, opts))
    return (derive(out) if derive else out).select(*_names(FEATURE_TABLE_COLUMNS, opts))


def _names(cols: list[str], opts: FeatureOptions) -> list[str]:
    """Feature names for the configured windows (default 1, 7, 30)."""
    if opts.windows == (1, 7, 30):
        return list(cols)
    out = []
    for c in cols:
        if c.endswith(("_1", "_7", "_30")):
            stem = c.rsplit("_", 1)[0]
            if c.endswith("_1"):
                out += [f"{stem}_{n}" for n in opts.windows]
        else:
            out.append(c)
    return out


def clustered_by_day(df: DataFrame) -> DataFrame:
    """Rows brought together by TX_TIME_DAYS before a write partitioned by day: few, large
    files per day. Spark sizes the tasks when the input is known: small days share one, a day
    with a large share of the rows is split."""
    return df.hint("rebalance", "tx_time_days")


def save_feature_table(df: DataFrame, table: str, buckets: int | None = None) -> None:
    """Overwrite the saved feature table, partitioned by day so that the split's per-day
    filters prune files. With ``buckets`` the rows of a customer are in one bucket of every day:
    what the split joins and adds up by customer then needs no shuffle of the features. A task
    writes one bucket, so there are as many files a day as buckets."""
    if buckets:
        writer = df.repartition(buckets, "customer_id").write.bucketBy(buckets, "customer_id").sortBy("customer_id")
    else:
        writer = clustered_by_day(df).write
    writer.mode("overwrite").partitionBy("tx_time_days").saveAsTable(table)


def update_feature_table(
    tx: DataFrame, table: str, opts: FeatureOptions = DEFAULT, changed: int | None = None
) -> None:
    """Bring the saved table up to date with ``tx`` without rebuilding it: days behind its last
    are added, and if transactions of the earlier day ``changed`` (counted as TX_TIME_DAYS) have
    been added or corrected, the days whose windows hold that day are written anew. Other days'
    files stay as they are. With D3 the last day has no features yet; the update that brings a
    later one adds it."""
    spark = tx.sparkSession
    saved = spark.table(table).agg(F.max("tx_time_days")).first()[0]  # from the partitions' names
    behind = -1 if saved is None else saved
    parts = [(behind + 1, None)]
    if changed is not None and changed <= behind:
        parts.insert(0, (changed, min(behind, changed + reach(opts))))
    mode = "spark.sql.sources.partitionOverwriteMode"
    kept = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # only the days that the rows belong to
    try:
        for days in parts:
            rows = feature_table(tx, opts, days).select(*spark.table(table).columns)
            clustered_by_day(rows).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, kept)
