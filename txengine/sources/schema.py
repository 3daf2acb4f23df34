"""The typed transaction table (the reference's fact table, 9 columns)."""

from pyspark.sql import types as T

TX_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType(), True),
        T.StructField("tx_datetime", T.TimestampNTZType(), True),
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("terminal_id", T.LongType(), True),
        T.StructField("tx_amount", T.DoubleType(), True),
        T.StructField("tx_time_seconds", T.LongType(), True),
        T.StructField("tx_time_days", T.LongType(), True),
        T.StructField("tx_fraud", T.LongType(), True),
        T.StructField("tx_fraud_scenario", T.LongType(), True),
    ]
)

TX_COLUMNS = [f.name for f in TX_SCHEMA.fields]

#: Beside them in the managed table: the file that a row was loaded from.
LOADED_FROM = "loaded_from"

FLAG_COLUMNS = ["tx_during_weekend", "tx_during_night"]

# Feature columns in the order of the reference's saved feature table (fixed values).
CUSTOMER_FEATURES = [
    "cust_avg_amount_1", "cust_cnt_tx_1",
    "cust_avg_amount_7", "cust_cnt_tx_7",
    "cust_avg_amount_30", "cust_cnt_tx_30",
]
TERMINAL_FEATURES = [
    "nb_tx_window_1", "term_risk_1",
    "nb_tx_window_7", "term_risk_7",
    "nb_tx_window_30", "term_risk_30",
]
FEATURE_TABLE_COLUMNS = [
    "transaction_id", "tx_datetime", "customer_id", "terminal_id", "tx_time_seconds",
    "tx_time_days", "tx_amount", "tx_fraud", "tx_fraud_scenario",
    *FLAG_COLUMNS, *CUSTOMER_FEATURES, *TERMINAL_FEATURES,
]

# Model inputs and label (fixed values from the reference's training step).
MODEL_FEATURES = [
    "tx_amount", "tx_during_weekend", "tx_during_night", "cust_cnt_tx_1",
    "cust_avg_amount_1", "cust_cnt_tx_7", "cust_avg_amount_7", "cust_cnt_tx_30",
    "cust_avg_amount_30", "nb_tx_window_1", "term_risk_1", "nb_tx_window_7", "term_risk_7",
    "nb_tx_window_30", "term_risk_30",
]
LABEL = "tx_fraud"
