"""CSV stage load (gzip, no header, typed, FAILFAST) and the table round trip."""

import pytest
from pyspark.sql import functions as F

import handmade
from txengine.session import scratch_path
from txengine.sources.catalog import create_namespace, create_transaction_table, dimension
from txengine.sources.schema import TX_SCHEMA
from txengine.sources.transactions import copy_into, read_transactions_csv, write_transactions_csv


def test_csv_round_trip_keeps_nulls_and_microseconds(spark):
    tx = handmade.spark_table(spark)
    path = scratch_path(spark, "csv_test")
    write_transactions_csv(tx, path)
    back = read_transactions_csv(spark, path)
    assert back.schema == TX_SCHEMA
    assert back.exceptAll(tx).count() == 0 and tx.exceptAll(back).count() == 0


def test_bad_row_fails_the_load(spark):
    path = scratch_path(spark, "csv_bad")
    spark.createDataFrame([("1,not-a-time,3,4,5.0,6,7,0,0",)], "v string").write.text(path)
    with pytest.raises(Exception):
        read_transactions_csv(spark, path).collect()


def test_copy_into_table_and_dimensions(spark):
    db = "txengine_test_db"
    create_namespace(spark, db)
    table = f"{db}.customer_transactions_fraud"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    create_transaction_table(spark, table)
    path = scratch_path(spark, "csv_copy")
    write_transactions_csv(handmade.spark_table(spark), path)
    for _ in range(2):  # a repeated load changes nothing
        copy_into(spark, path, table)
        assert spark.table(table).count() == len(handmade.rows())
    copy_into(spark, path, table, append=True)  # nor does appending files already loaded
    assert spark.table(table).count() == len(handmade.rows())
    more = scratch_path(spark, "csv_more")
    write_transactions_csv(handmade.spark_table(spark), more)
    for _ in range(2):
        copy_into(spark, more, table, append=True)
        assert spark.table(table).count() == 2 * len(handmade.rows())
    create_transaction_table(spark, table)
    assert spark.table(table).count() == 0
    copy_into(spark, path, table)
    cust = dimension(spark.table(table), "customer_id").collect()
    assert [r[0] for r in cust] == sorted({r[2] for r in handmade.rows()}, key=lambda v: (v is not None, v))
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def _staged(path: str, name: str, lines: list[str]) -> None:
    import gzip
    import os

    local = path.replace("file:", "", 1)
    os.makedirs(local, exist_ok=True)
    with gzip.open(f"{local}/{name}", "wt") as f:
        f.write("\n".join(lines) + "\n")


def test_a_load_is_visible_whole_or_not_at_all(spark):
    """A load that stops half-way has loaded nothing; run again, it doubles nothing; a file of the
    same name that has changed is noticed."""
    db = "txengine_test_db"
    create_namespace(spark, db)
    table = f"{db}.loads_whole"
    create_transaction_table(spark, table)
    path = scratch_path(spark, "csv_whole")
    line = "{},2018-04-01 00:00:31,596,3156,57.16,31,0,0,0"
    _staged(path, "a b|1.csv.gz", [line.format(i) for i in range(3)])
    copy_into(spark, path, table, append=True)
    _staged(path, "c.csv.gz", [line.format(i) for i in range(3, 5)])
    _staged(path, "d.csv.gz", ["5,not-a-time,3,4,5.0,6,7,0,0"])
    with pytest.raises(Exception):
        copy_into(spark, path, table, append=True)
    assert spark.table(table).count() == 3  # nothing of c either
    _staged(path, "d.csv.gz", [line.format(5)])
    for _ in range(2):
        copy_into(spark, path, table, append=True)
        assert sorted(r[0] for r in spark.table(table).select("transaction_id").collect()) == list(range(6))
    _staged(path, "c.csv.gz", [line.format(i) for i in range(3, 9)])
    with pytest.raises(ValueError, match="c.csv.gz"):
        copy_into(spark, path, table, append=True)
    assert spark.table(table).count() == 6
    copy_into(spark, path, table)  # a load of its own replaces all
    assert spark.table(table).count() == 10
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_gzip_load_is_spread(spark):
    path = scratch_path(spark, "csv_spread")
    write_transactions_csv(handmade.spark_table(spark).coalesce(1), path)
    plan = read_transactions_csv(spark, path)._jdf.queryExecution().sparkPlan().toString()
    assert "REBALANCE" in plan


def test_reads_whole_second_timestamps(spark):
    """Rows laid out as the reference's stage file: 9 columns, no header, times without
    fractions of a second."""
    import datetime as dt
    import gzip
    import os

    path = scratch_path(spark, "csv_ref")
    local = path.replace("file:", "", 1)
    os.makedirs(local, exist_ok=True)
    lines = [
        "0,2018-04-01 00:00:31,596,3156,57.16,31,0,0,0",
        "1,2018-04-01 00:02:10,4961,3412,81.51,130,0,0,0",
        "2,2018-04-01 00:07:56,2,1365,146.0,476,0,1,1",
    ]
    with gzip.open(f"{local}/part-0.csv.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    rows = read_transactions_csv(spark, path).orderBy("transaction_id").collect()
    assert len(rows) == 3
    assert rows[0]["tx_datetime"] == dt.datetime(2018, 4, 1, 0, 0, 31)
    assert rows[2]["tx_amount"] == 146.0 and rows[2]["tx_fraud"] == 1
