"""Hand-made transactions for the edge cases of FIXTURES.md §4, as Spark and DuckDB tables."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pandas as pd

from txengine.sources.schema import TX_COLUMNS, TX_SCHEMA

DAY0 = dt.datetime(2024, 3, 1)
SPLIT_START = "2024-03-03"  # s0 = day 2; train days 2..9 (midnight of day 9 included)
S0 = 2


def _row(i, day, hh, mm, ss, cust, term, amount, fraud, micro=0):
    ts = DAY0 + dt.timedelta(days=day, hours=hh, minutes=mm, seconds=ss, microseconds=micro)
    secs = day * 86400 + hh * 3600 + mm * 60 + ss
    scenario = None if fraud is None else (0 if fraud == 0 else 1 + (term or 0) % 3)
    return (i, ts, cust, term, amount, secs, day, fraud, scenario)


def rows() -> list[tuple]:
    rnd = random.Random(7)
    out = []
    i = 0
    # background: customers 1..6 on terminals 10..13, most days 0..25, no fraud
    for day in range(26):
        for cust in range(1, 7):
            if rnd.random() < 0.35:
                continue  # days without rows
            for _ in range(rnd.randint(1, 3)):
                i += 1
                out.append(
                    _row(i, day, rnd.randint(0, 23), rnd.randint(0, 59), rnd.randint(0, 59),
                         cust, 10 + rnd.randint(0, 3), round(rnd.uniform(1, 300), 2), 0,
                         rnd.randint(0, 999_999))
                )
    special = [
        # equal timestamps (peers in RANGE frames), customer 1 / terminal 10, day 3
        (3, 10, 0, 0, 1, 10, 40.0, 0), (3, 10, 0, 0, 1, 10, 60.0, 1), (3, 10, 0, 0, 1, 10, 5.5, 0),
        # NULL amount, day 4
        (4, 9, 30, 0, 2, 11, None, 0),
        # all labels NULL so far today on terminal 12, day 5; later a labelled row
        (5, 1, 0, 0, 3, 12, 10.0, None), (5, 2, 0, 0, 4, 12, 11.0, None), (5, 3, 0, 0, 2, 12, 12.0, 1),
        # NULL customer and NULL terminal, day 6
        (6, 12, 0, 0, None, 10, 70.0, 1), (6, 12, 5, 0, 3, None, 80.0, 1),
        # zero and negative amounts, customer 4, day 7
        (7, 8, 0, 0, 4, 13, 0.0, 0), (7, 8, 1, 0, 4, 13, -5.0, 0),
        # frauds on delay boundaries s0+5 .. s0+13
        (S0 + 5, 14, 0, 0, 21, 11, 99.0, 1), (S0 + 6, 14, 0, 0, 22, 11, 99.0, 1),
        (S0 + 7, 14, 0, 0, 23, 11, 99.0, 1), (S0 + 12, 14, 0, 0, 24, 11, 99.0, 1),
        (S0 + 13, 14, 0, 0, 25, 11, 99.0, 1),
        # customer frauded in training
        (4, 15, 0, 0, 26, 12, 500.0, 1),
        # training bounds exactly at midnight (start included, end included)
        (S0, 0, 0, 0, 27, 13, 20.0, 0), (S0 + 7, 0, 0, 0, 27, 13, 21.0, 1),
        (S0 + 7, 0, 0, 1, 27, 13, 22.0, 0),
    ]
    for day, hh, mm, ss, cust, term, amount, fraud in special:
        i += 1
        out.append(_row(i, day, hh, mm, ss, cust, term, amount, fraud))
    # the boundary customers also shop on every test day s0+14 .. s0+20
    for cust in [21, 22, 23, 24, 25, 26, 27]:
        for day in range(S0 + 14, S0 + 21):
            i += 1
            out.append(_row(i, day, 12, cust, 0, cust, 10, 15.0, 0))
    # an exact duplicate row on a test day
    out.append(out[-1])
    # the last calendar day (dropped by the features, D3)
    i += 1
    out.append(_row(i, 27, 23, 0, 0, 1, 10, 33.0, 0))
    # a row without a timestamp (matches no calendar day anywhere)
    i += 1
    out.append((i, None, 2, 11, 44.0, None, None, 0, 0))
    return out


def spark_table(spark):
    return spark.createDataFrame(rows(), TX_SCHEMA)


def duck_table(con: duckdb.DuckDBPyConnection, name: str = "tx_input") -> None:
    pdf = pd.DataFrame(rows(), columns=TX_COLUMNS)
    for c in ["transaction_id", "customer_id", "terminal_id", "tx_time_seconds", "tx_time_days",
              "tx_fraud", "tx_fraud_scenario"]:
        pdf[c] = pdf[c].astype("Int64")
    pdf["tx_amount"] = pdf["tx_amount"].astype("Float64")
    con.register("tx_pdf", pdf)
    con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM tx_pdf")
