"""Transaction sources: the typed CSV load of the reference, plus adapters that present the
driver's Parquet fixtures as the 9-column transaction table (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.sources.schema import LOADED_FROM, TX_COLUMNS, TX_SCHEMA

# CSV layout of the reference's load: comma separated, no header, gzip (fixed values).
CSV_OPTIONS = {
    "sep": ",",
    "header": "false",
    # Up to six fraction digits are accepted on read; six are always written.
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}


def _seconds_since(ts: Column, first_day: Column) -> Column:
    """Whole seconds from midnight of ``first_day`` to ``ts`` (BIGINT, time-zone free)."""
    days = F.datediff(F.to_date(ts), first_day).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def _fraud_columns(is_fraud: Column, terminal: Column) -> dict[str, Column]:
    fraud = F.when(is_fraud, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    scenario = F.when(is_fraud, F.lit(1) + terminal % 3).otherwise(F.lit(0)).cast("bigint")
    return {"tx_fraud": fraud, "tx_fraud_scenario": scenario}


def events_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as transactions (FIXTURES.md §2).

    The first day is a one-row scalar subquery, evaluated once per query and inlined as a
    constant; nothing is collected to the driver and no join is added.
    """
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    first_day = ev.select(F.min(F.to_date("ts"))).scalar()
    ts = F.col("ts")
    terminal = F.get_json_object("props", "$.k").cast("bigint")
    is_fraud = (F.col("event_type") == "error") & (F.col("value") > 150)
    return ev.select(
        F.col("event_id").alias("transaction_id"),
        ts.alias("tx_datetime"),
        F.col("user_id").alias("customer_id"),
        terminal.alias("terminal_id"),
        F.col("value").alias("tx_amount"),
        _seconds_since(ts, first_day).alias("tx_time_seconds"),
        F.datediff(F.to_date(ts), first_day).cast("bigint").alias("tx_time_days"),
        *[c.alias(n) for n, c in _fraud_columns(is_fraud, terminal).items()],
    )


def lineitem_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` + ``orders`` as transactions, without the columns that follow from the others
    (FIXTURES.md §3).

    ``transaction_id`` = l_orderkey * 8 + l_linenumber is *not* unique in this data; use it
    for timing and grouped results only. The join to ``orders`` is a plain equi-join on
    the order key (both sides large: sort-merge, AQE may re-plan it); a line meets it with
    the columns that are kept.
    """
    is_fraud = (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.095)
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_extendedprice",
        _fraud_columns(is_fraud, F.col("l_suppkey"))["tx_fraud"].alias("tx_fraud"),
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    joined = li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "left")
    return joined.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_shipdate").alias("tx_datetime"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("terminal_id"),
        F.col("l_extendedprice").alias("tx_amount"),
        "tx_fraud",
    )


def lineitem_derived(tx: DataFrame, sf_dir: str) -> DataFrame:
    """``tx`` with the columns that ``lineitem_joined`` leaves out."""
    li = tx.sparkSession.read.parquet(f"{sf_dir}/lineitem.parquet")
    first_day = li.select(F.min(F.to_date("l_shipdate"))).scalar()
    ts = F.col("tx_datetime")
    return tx.withColumns(
        {
            "tx_time_seconds": _seconds_since(ts, first_day),
            "tx_time_days": F.datediff(F.to_date(ts), first_day).cast("bigint"),
            "tx_fraud_scenario": _fraud_columns(F.col("tx_fraud") == 1, F.col("terminal_id"))["tx_fraud_scenario"],
        }
    )


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` + ``orders`` as transactions: the wide-calendar fixture (FIXTURES.md §3)."""
    return lineitem_derived(lineitem_joined(spark, sf_dir), sf_dir).select(*TX_COLUMNS)


def load_transactions(spark: SparkSession, source: str) -> DataFrame:
    """Read the typed table by name (catalog) or from a Parquet path; the schema is asserted,
    never inferred."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    missing = [c for c in TX_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"not a transaction table, missing columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TX_SCHEMA.fields])


def write_transactions_csv(df: DataFrame, path: str) -> None:
    """Write the 9 columns as gzip CSV without header (the reference's stage format)."""
    (
        df.select(*TX_COLUMNS)
        .write.mode("overwrite")
        .options(**CSV_OPTIONS)
        .option("compression", "gzip")
        .csv(path)
    )


def read_transactions_csv(
    spark: SparkSession, path: str | list[str], spread: bool = True, marked: bool = False
) -> DataFrame:
    """Typed CSV read: explicit schema, FAILFAST (a bad row aborts the load, as the
    reference's COPY does). A gzip file is one split, parsed by one task; ``spread`` deals its
    rows out right after, in tasks of a size that Spark chooses. ``marked`` adds the file."""
    df = (
        spark.read.schema(TX_SCHEMA)
        .options(**CSV_OPTIONS)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    if marked:
        df = df.select("*", _file_mark().alias(LOADED_FROM))
    return df.hint("rebalance") if spread else df


def _file_mark() -> Column:
    """Path, size and time of the file that a row is read from."""
    time = F.unix_millis("_metadata.file_modification_time")
    return F.concat_ws("|", "_metadata.file_path", F.col("_metadata.file_size").cast("string"), time.cast("string"))


def _path_of(mark: Column) -> Column:
    return F.regexp_replace(mark, r"\|[0-9]*\|[0-9]*$", "")


def copy_into(spark: SparkSession, path: str, table: str, append: bool = False, spread: bool = True) -> None:
    """Load a staged CSV file set into a managed table. By default the table then holds these
    files' rows and nothing else, so that a repeated load changes nothing; ``append`` adds the
    files that have not been loaded before.

    Every row says what file it came from (path, size and time), so data and ledger are one write
    and become visible together: a load that stops half-way has loaded nothing, and can be run
    again. A file that has changed since it was loaded is an error; its rows are in the table
    already, and only the caller knows which to keep. A file without rows leaves no mark, and
    loading it again changes nothing."""
    if not append:
        read_transactions_csv(spark, path, spread, marked=True).write.mode("overwrite").saveAsTable(table)
        return
    staged = spark.read.format("binaryFile").load(path).select("path", _file_mark().alias("mark"))  # a listing
    loaded = spark.table(table).select(F.col(LOADED_FROM).alias("mark")).where("mark is not null").distinct()
    known = loaded.select(_path_of(F.col("mark")).alias("file"), F.lit(True).alias("known")).distinct()
    new = staged.join(loaded, "mark", "left_anti").withColumn("file", _path_of(F.col("mark")))
    files = new.join(known, "file", "left").select("path", "known").collect()  # names of one stage folder
    changed = sorted(r["path"] for r in files if r["known"])
    if changed:
        raise ValueError(f"changed since they were loaded: {changed}")
    if files:
        named = [r["path"] for r in files]
        read_transactions_csv(spark, named, spread, marked=True).write.mode("append").saveAsTable(table)
