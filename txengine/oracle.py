"""DuckDB SQL oracles, one per query key.

Written from what the columns mean (per key and day, a sum over the days of its window by a
range join), not from our Spark plans, so the comparison tests the plans. Every query starts
from the raw ``events`` view through the same adapter CTE as ``sources.events_transactions``.
Amounts are summed as decimals.
"""

from __future__ import annotations

from txengine.sources.schema import MODEL_FEATURES

# events -> 9-column transactions (FIXTURES.md §2)
TX_CTE = """
bounds0 AS (SELECT min(CAST(ts AS DATE)) AS d0 FROM events),
tx AS (
  SELECT e.event_id AS transaction_id,
         e.ts AS tx_datetime,
         e.user_id AS customer_id,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS terminal_id,
         e.value AS tx_amount,
         CAST((CAST(e.ts AS DATE) - b.d0) * 86400 + hour(e.ts) * 3600 + minute(e.ts) * 60
              + second(e.ts) AS BIGINT) AS tx_time_seconds,
         CAST(CAST(e.ts AS DATE) - b.d0 AS BIGINT) AS tx_time_days,
         CAST(CASE WHEN e.event_type = 'error' AND e.value > 150 THEN 1 ELSE 0 END AS BIGINT)
           AS tx_fraud,
         CAST(CASE WHEN e.event_type = 'error' AND e.value > 150
                   THEN 1 + CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 3
                   ELSE 0 END AS BIGINT) AS tx_fraud_scenario
  FROM events e CROSS JOIN bounds0 b
)"""

# lineitem + orders -> 9-column transactions (FIXTURES.md §3, the wide-calendar fixture)
LINEITEM_TX_CTE = """
bounds0 AS (SELECT min(CAST(l_shipdate AS DATE)) AS d0 FROM lineitem),
tx AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS transaction_id,
         l.l_shipdate AS tx_datetime,
         o.o_custkey AS customer_id,
         l.l_suppkey AS terminal_id,
         l.l_extendedprice AS tx_amount,
         CAST((CAST(l.l_shipdate AS DATE) - b.d0) * 86400 + hour(l.l_shipdate) * 3600
              + minute(l.l_shipdate) * 60 + second(l.l_shipdate) AS BIGINT) AS tx_time_seconds,
         CAST(CAST(l.l_shipdate AS DATE) - b.d0 AS BIGINT) AS tx_time_days,
         CAST(CASE WHEN l.l_returnflag = 'R' AND l.l_discount > 0.095 THEN 1 ELSE 0 END AS BIGINT)
           AS tx_fraud,
         CAST(CASE WHEN l.l_returnflag = 'R' AND l.l_discount > 0.095 THEN 1 + l.l_suppkey % 3
                   ELSE 0 END AS BIGINT) AS tx_fraud_scenario
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey CROSS JOIN bounds0 b
)"""


def on_lineitem(sql: str) -> str:
    """Re-aim an oracle at the lineitem + orders fixture."""
    return sql.replace(TX_CTE, LINEITEM_TX_CTE, 1)


def dec(x: str = "tx_amount") -> str:
    return f"CAST({x} AS DECIMAL(28,6))"


def short(x: str) -> str:
    return f"CAST({x} AS DECIMAL(38,6))"


def whole(x: str) -> str:
    """A decimal as the nearest DOUBLE (a direct cast of wide decimals rounds twice)."""
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def money_sum(x: str = "tx_amount") -> str:
    return f"CAST(sum({dec(x)}) AS DOUBLE)"


def with_tx(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {TX_CTE}{extra}\n{body}"


def on_table(sql: str, table: str) -> str:
    """Re-aim an oracle at a ready 9-column transaction table instead of ``events``."""
    return sql.replace(TX_CTE, f"\ntx AS (SELECT * FROM {table})", 1)


NUMERIC = [
    "transaction_id", "customer_id", "terminal_id", "tx_amount",
    "tx_time_seconds", "tx_time_days", "tx_fraud", "tx_fraud_scenario",
]

ANALYSIS = {
    "tx_scan": with_tx("SELECT * FROM tx"),
    "tx_count": with_tx("SELECT count(*) AS total_rows FROM tx"),
    "amount_summary": with_tx(
        f"""SELECT min(tx_amount) AS min_amount, max(tx_amount) AS max_amount,
       {money_sum()} / count(tx_amount) AS avg_amount,
       {money_sum()} AS total_amount
FROM tx"""
    ),
    "amount_by_scenario": with_tx(
        f"""SELECT tx_fraud_scenario, {money_sum()} AS total_amount
FROM tx GROUP BY tx_fraud_scenario ORDER BY tx_fraud_scenario"""
    ),
    "avg_by_scenario": with_tx(
        f"""SELECT tx_fraud_scenario, {money_sum()} / count(tx_amount) AS avg_amount
FROM tx GROUP BY tx_fraud_scenario ORDER BY avg_amount DESC"""
    ),
    "top_spenders": with_tx(
        f"""SELECT customer_id, total_spend,
       round(total_spend * 1.0 / nullif((SELECT sum(CAST(round(tx_amount) AS BIGINT)) FROM tx), 0) * 100, 2)
         AS percentage_contribution
FROM (SELECT customer_id, {money_sum()} AS total_spend FROM tx GROUP BY customer_id)
ORDER BY total_spend DESC, customer_id
LIMIT 10"""
    ),
    "numeric_describe": with_tx(
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS column_name, count({c}) AS "count",
       CAST(sum({dec(c)}) AS DOUBLE) / nullif(count({c}), 0) AS mean,
       CASE WHEN count({c}) > 1 THEN sqrt(greatest({whole(f"sum({short(c)} * {short(c)})")}
         - {whole(f"sum({dec(c)})")} * {whole(f"sum({dec(c)})")} / count({c}), 0.0) / (count({c}) - 1)) END AS stddev,
       CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max" FROM tx"""
            for c in NUMERIC
        )
    ),
    "tx_by_day": with_tx(
        """SELECT CAST(tx_datetime AS DATE) AS "date", count(*) AS "count"
FROM tx GROUP BY 1 ORDER BY 1"""
    ),
    "fraud_share": with_tx(
        """SELECT tx_fraud, nb_tx_day,
       CAST(nb_tx_day AS DOUBLE) / CAST(sum(nb_tx_day) OVER () AS DOUBLE) * 100 AS percentage
FROM (SELECT tx_fraud, count(transaction_id) AS nb_tx_day FROM tx GROUP BY tx_fraud)"""
    ),
    "fraud_by_customer": with_tx(
        """SELECT customer_id, CAST(sum(tx_fraud) AS BIGINT) AS nbr_fraud_trx
FROM tx WHERE tx_fraud = 1 GROUP BY customer_id"""
    ),
    "distinct_customers": with_tx(
        "SELECT DISTINCT customer_id FROM tx ORDER BY customer_id"
    ),
    "distinct_terminals": with_tx(
        "SELECT DISTINCT terminal_id FROM tx ORDER BY terminal_id"
    ),
    "csv_ingest": with_tx("SELECT * FROM tx"),
}




# --------------------------------------------------------------------------- features
GRID_CTES = [
    """flags AS (
  SELECT *, CAST(tx_datetime AS DATE) AS d,
         coalesce(CAST(dayofweek(tx_datetime) IN (0, 6) AS INTEGER), 0) AS tx_during_weekend,
         coalesce(CAST(hour(tx_datetime) NOT BETWEEN 6 AND 20 AS INTEGER), 0) AS tx_during_night
  FROM tx)""",
    "span AS (SELECT min(d) AS lo, max(d) AS hi FROM flags)",
    "days AS (SELECT CAST(unnest(generate_series(lo, hi - 1, INTERVAL 1 DAY)) AS DATE) AS tx_date FROM span WHERE hi > lo)",
    "cust_day AS (SELECT tx_date, customer_id FROM days, (SELECT DISTINCT customer_id FROM tx))",
    "term_day AS (SELECT tx_date, terminal_id FROM days, (SELECT DISTINCT terminal_id FROM tx))",
    f"""cust_tot AS (
  SELECT customer_id, d, sum({dec()}) AS amt, sum(CASE WHEN tx_amount > 0 THEN 1 ELSE 0 END) AS n
  FROM flags GROUP BY ALL)""",
    """term_tot AS (
  SELECT terminal_id, d, sum(tx_fraud) AS fr, count(tx_fraud) AS n FROM flags GROUP BY ALL)""",
]


def _window(keys: str, key: str, totals: str, sums: dict[str, str], last: int, first: int) -> str:
    """Per row (key, day) of ``keys``: sums over the key's days from ``last`` to ``first``
    days ago; 0 where there is none."""
    cols = ", ".join(f"coalesce(sum(h.{c}), 0) AS {name}" for name, c in sums.items())
    return (
        f"SELECT k.{key}, k.d, {cols} FROM {keys} k LEFT JOIN {totals} h"
        f" ON h.{key} = k.{key} AND h.d BETWEEN k.d - {last} AND k.d - {first} GROUP BY k.{key}, k.d"
    )


def _grid(key: str, totals: str, grid: str, day_cols: str, windows: dict[str, tuple[str, int]]) -> str:
    """Per grid day: its own totals, and for each name the sum of a column over the n days
    before; NULL on the first day, which no day comes before."""
    sums = ", ".join(
        f"""(SELECT coalesce(sum(h.{c}), 0) FROM {totals} h WHERE h.{key} = g.{key}
            AND h.d BETWEEN g.tx_date - {n} AND g.tx_date - 1) AS {name}"""
        for name, (c, n) in windows.items()
    )
    nulls = ", ".join(f"CASE WHEN tx_date > (SELECT lo FROM span) THEN {name} END AS {name}" for name in windows)
    return f"""SELECT tx_date, {key}, {day_cols}, {nulls} FROM (
  SELECT g.tx_date, g.{key}, t.*EXCLUDE ({key}, d), {sums}
  FROM {grid} g LEFT JOIN {totals} t ON t.{key} = g.{key} AND t.d = g.tx_date)"""


def feature_ctes(window_7: int = 7, labels_today: bool = False, all_days: bool = False) -> list[str]:
    """CTEs up to ``cust_feat``, ``term_feat`` and ``features``. ``window_7``: days behind the
    7-day terminal columns; ``labels_today``: no risk while all of today's labels so far are
    NULL; ``all_days``: the last day's rows stay."""
    keep = "d <= (SELECT hi FROM span)" if all_days else "d < (SELECT hi FROM span)"
    ctes = [*GRID_CTES, f"cal AS (SELECT *, row_number() OVER () AS rid FROM flags WHERE {keep})"]
    ctes.append(
        f"""cust_now AS (SELECT rid, count(*) OVER w AS n, sum({dec()}) OVER w AS amt FROM cal
  WHERE customer_id IS NOT NULL
  WINDOW w AS (PARTITION BY customer_id, d ORDER BY tx_datetime RANGE UNBOUNDED PRECEDING))"""
    )
    ctes.append(
        """term_now AS (SELECT rid, count(tx_fraud) OVER w AS labels FROM cal WHERE terminal_id IS NOT NULL
  WINDOW w AS (PARTITION BY terminal_id, d ORDER BY tx_datetime RANGE UNBOUNDED PRECEDING))"""
    )
    ctes.append("cust_keys AS (SELECT DISTINCT customer_id, d FROM cal WHERE customer_id IS NOT NULL)")
    ctes.append("term_keys AS (SELECT DISTINCT terminal_id, d FROM cal WHERE terminal_id IS NOT NULL)")
    c_cols, c_joins, t_cols, t_joins = [], [], [], []
    for n in (1, 7, 30):
        ctes.append(f"c{n} AS ({_window('cust_keys', 'customer_id', 'cust_tot', {'n': 'n', 'amt': 'amt'}, n, 1)})")
        c_joins.append(f"JOIN c{n} ON c{n}.customer_id = x.customer_id AND c{n}.d = x.d")
        c_cols.append(
            f"CAST(c{n}.amt + now.amt AS DOUBLE) / (c{n}.n + now.n) AS cust_avg_amount_{n},"
            f" CAST(c{n}.n + now.n AS BIGINT) AS cust_cnt_tx_{n}"
        )
        reach = window_7 if n == 7 else n
        ctes.append(f"t{n} AS ({_window('term_keys', 'terminal_id', 'term_tot', {'n': 'n', 'fr': 'fr'}, reach + 7, 8)})")
        t_joins.append(f"JOIN t{n} ON t{n}.terminal_id = x.terminal_id AND t{n}.d = x.d")
        known = f"t{n}.fr > 0" + (" AND now.labels > 0" if labels_today else "")
        later = "x.d > (SELECT lo FROM span)"
        t_cols.append(
            f"CAST(CASE WHEN {later} THEN t{n}.n END AS BIGINT) AS nb_tx_window_{n},"
            f" CAST(CASE WHEN {later} AND {known} THEN t{n}.fr / t{n}.n ELSE 0 END AS DOUBLE) AS term_risk_{n}"
        )
    ctes.append(f"cust_feat AS (SELECT x.*, {', '.join(c_cols)} FROM cal x JOIN cust_now now USING (rid) {' '.join(c_joins)})")
    ctes.append(f"term_feat AS (SELECT x.rid, {', '.join(t_cols)} FROM cal x JOIN term_now now USING (rid) {' '.join(t_joins)})")
    ctes.append(f"features AS (SELECT {FEATURE_COLS} FROM cust_feat JOIN term_feat USING (rid))")
    return ctes


FEATURE_COLS = """transaction_id, tx_datetime, customer_id, terminal_id, tx_time_seconds,
  tx_time_days, tx_amount, tx_fraud, tx_fraud_scenario, tx_during_weekend, tx_during_night,
  cust_avg_amount_1, cust_cnt_tx_1, cust_avg_amount_7, cust_cnt_tx_7, cust_avg_amount_30,
  cust_cnt_tx_30, nb_tx_window_1, term_risk_1, nb_tx_window_7, term_risk_7, nb_tx_window_30,
  term_risk_30"""

FEATURE_TABLE_CTES = feature_ctes()


def with_grid(body: str, *more: str) -> str:
    return with_tx(body, *GRID_CTES, *more)


_CUST_WINDOWS = {
    "cust_tx_prev_1": ("n", 1), "cust_tx_prev_7": ("n", 7), "cust_tx_prev_30": ("n", 30),
    "cust_tot_amt_prev_1": ("amt", 1), "cust_tot_amt_prev_7": ("amt", 7), "cust_tot_amt_prev_30": ("amt", 30),
}
_TERM_WINDOWS = {
    "nb_fraud_delay": ("fr", 7), "nb_tx_delay": ("n", 7),
    "nb_tx_delay_window_1": ("n", 8), "nb_tx_delay_window_7": ("n", 14),
    "nb_tx_delay_window_7_literal": ("n", 8), "nb_tx_delay_window_30": ("n", 37),
    "nb_fraud_delay_window_1": ("fr", 8), "nb_fraud_delay_window_7": ("fr", 14),
    "nb_fraud_delay_window_7_literal": ("fr", 8), "nb_fraud_delay_window_30": ("fr", 37),
}
_CUST_GRID = _grid(
    "customer_id", "cust_tot", "cust_day",
    "CAST(coalesce(amt, 0) AS DOUBLE) AS tot_amount, CAST(coalesce(n, 0) AS BIGINT) AS no_trx", _CUST_WINDOWS,
)
_TERM_GRID = _grid(
    "terminal_id", "term_tot", "term_day",
    "CAST(coalesce(fr, 0) AS BIGINT) AS nb_fraud, CAST(coalesce(n, 0) AS BIGINT) AS no_trx", _TERM_WINDOWS,
)


def _typed(windows: dict[str, tuple[str, int]]) -> str:
    return ", ".join(f"CAST({k} AS {'DOUBLE' if c == 'amt' else 'BIGINT'}) AS {k}" for k, (c, _) in windows.items())


FEATURES = {
    "date_time_features": with_grid("SELECT * EXCLUDE (d) FROM flags"),
    "date_bounds": with_grid("SELECT lo AS start_date, CAST(hi - lo AS BIGINT) AS no_days FROM span"),
    "calendar_days": with_grid("SELECT tx_date FROM days"),
    "customer_day_grid": with_grid("SELECT tx_date, customer_id FROM cust_day"),
    "terminal_day_grid": with_grid("SELECT tx_date, terminal_id FROM term_day"),
    "customer_daily": with_grid(f"SELECT customer_id, tx_date, tot_amount, no_trx FROM ({_CUST_GRID})"),
    "customer_trailing_daily": with_grid(
        f"SELECT tx_date, customer_id, no_trx, tot_amount, {_typed(_CUST_WINDOWS)} FROM ({_CUST_GRID})"
    ),
    "customer_running_day": with_tx(
        f"""SELECT transaction_id, customer_id, tx_datetime, count(*) OVER r AS cur_day_trx,
       CAST(sum({dec()}) OVER r AS DOUBLE) AS cur_day_amt
FROM tx WHERE customer_id IS NOT NULL AND tx_datetime IS NOT NULL
WINDOW r AS (PARTITION BY customer_id, CAST(tx_datetime AS DATE) ORDER BY tx_datetime RANGE UNBOUNDED PRECEDING)"""
    ),
    "terminal_running_day": with_tx(
        """SELECT transaction_id, terminal_id, tx_datetime, count(*) OVER r AS cur_day_trx,
       CAST(sum(tx_fraud) OVER r AS BIGINT) AS cur_day_fraud
FROM tx WHERE terminal_id IS NOT NULL AND tx_datetime IS NOT NULL
WINDOW r AS (PARTITION BY terminal_id, CAST(tx_datetime AS DATE) ORDER BY tx_datetime RANGE UNBOUNDED PRECEDING)"""
    ),
    "customer_features": with_tx("SELECT * EXCLUDE (d, rid) FROM cust_feat", *FEATURE_TABLE_CTES),
    "terminal_daily": with_grid(f"SELECT terminal_id, tx_date, nb_fraud, no_trx FROM ({_TERM_GRID})"),
    "terminal_trailing_daily": with_grid(
        f"SELECT tx_date, terminal_id, no_trx, nb_fraud, {_typed(_TERM_WINDOWS)} FROM ({_TERM_GRID})"
    ),
    "terminal_features": with_tx(
        """SELECT transaction_id, terminal_id, tx_datetime, nb_tx_window_1, term_risk_1,
       nb_tx_window_7, term_risk_7, nb_tx_window_30, term_risk_30
FROM cal JOIN term_feat USING (rid)""",
        *FEATURE_TABLE_CTES,
    ),
    "feature_table": with_tx("SELECT * FROM features", *FEATURE_TABLE_CTES),
    "feature_table_literal": with_tx("SELECT * FROM features", *feature_ctes(window_7=1, labels_today=True)),
    "feature_table_all_days": with_tx("SELECT * FROM features", *feature_ctes(all_days=True)),
}
FEATURES["feature_table_saved"] = FEATURES["feature_table"]
FEATURES["feature_table_updated"] = FEATURES["feature_table"]
FEATURES["lineitem_feature_table"] = on_lineitem(FEATURES["feature_table"])




# --------------------------------------------------------------------------- split
# The reference's loop: for test day k, known = train frauds U frauds of the delay days
# s0+6 .. s0+6+k; test rows of day s0+14+k whose customer is not known; set union.
def split_ctes(start: str = "2024-01-09") -> list[str]:
    return [
        *FEATURE_TABLE_CTES,
        f"""train AS (SELECT * FROM features
  WHERE tx_datetime >= CAST('{start} 00:00:00' AS TIMESTAMP)
    AND tx_datetime <= CAST('{start} 00:00:00' AS TIMESTAMP) + INTERVAL 7 DAY)""",
        "s AS (SELECT min(tx_time_days) AS s0 FROM train)",
        "ks AS (SELECT unnest(generate_series(0, 6)) AS k)",
        """known_k AS (
  SELECT ks.k, tr.customer_id FROM ks, train tr WHERE tr.tx_fraud = 1
  UNION
  SELECT ks.k, f.customer_id FROM ks, features f, s
  WHERE f.tx_fraud = 1 AND f.tx_time_days BETWEEN s.s0 + 7 + 0 - 1 AND s.s0 + 7 + ks.k - 1)""",
        """test AS (
  SELECT DISTINCT t.* FROM features t, s, ks
  WHERE t.tx_time_days = s.s0 + 7 + 7 + ks.k
    AND NOT EXISTS (SELECT 1 FROM known_k kk
                    WHERE kk.k = ks.k AND kk.customer_id = t.customer_id))""",
    ]


def split_queries(start: str = "2024-01-09") -> dict[str, str]:
    ctes = split_ctes(start)
    return {
        "train_split": with_tx("SELECT * FROM train", *ctes),
        "test_split": with_tx("SELECT * FROM test", *ctes),
        "known_fraud_asof": with_tx(
            """SELECT customer_id, CAST(s0 + 14 + min(k) AS BIGINT) AS known_from
FROM known_k, s GROUP BY customer_id, s0""",
            *ctes,
        ),
        "split_stats": with_tx(
            """SELECT 'train' AS split, count(*) AS rows, CAST(sum(tx_fraud) AS BIGINT) AS frauds FROM train
UNION ALL
SELECT 'test' AS split, count(*) AS rows, CAST(sum(tx_fraud) AS BIGINT) AS frauds FROM test""",
            *ctes,
        ),
    }


SPLIT = split_queries()


# --------------------------------------------------------------------------- assessment
# Fixed-rule scores on the test set stand in for the models (exact oracle).
def assess_ctes(start: str = "2024-01-09") -> list[str]:
    return [
        *split_ctes(start),
        """scored AS (
      SELECT *, CASE WHEN tx_amount > 150 THEN 1 ELSE 0 END AS prediction_lm,
                CASE WHEN term_risk_30 > 0 THEN 1 ELSE 0 END AS prediction_rf
      FROM test)""",
        """stacked AS (
      SELECT 'lm' AS model, tx_fraud AS actual, prediction_lm AS predicted FROM scored
      UNION ALL
      SELECT 'rf' AS model, tx_fraud AS actual, prediction_rf AS predicted FROM scored)""",
        """counts AS (
      SELECT model,
             count(*) FILTER (WHERE actual = 1 AND predicted = 1) AS tp,
             count(*) FILTER (WHERE actual = 0 AND predicted = 1) AS fp,
             count(*) FILTER (WHERE actual = 1 AND predicted = 0) AS fn,
             count(*) FILTER (WHERE actual = 0 AND predicted = 0) AS tn
      FROM stacked GROUP BY model)""",
    ]


def _ratio(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / CAST(nullif({den}, 0) AS DOUBLE), 0.0)"


def assess_queries(start: str = "2024-01-09") -> dict[str, str]:
    ctes = assess_ctes(start)
    return {
        "confusion_matrix": with_tx(
            """SELECT model, actual,
           count(*) FILTER (WHERE predicted = 0) AS predicted_0,
           count(*) FILTER (WHERE predicted = 1) AS predicted_1
    FROM stacked GROUP BY model, actual""",
            *ctes,
        ),
        "classification_metrics": with_tx(
            f"""SELECT model, tp, fp, fn, tn,
           {_ratio("tp + tn", "tp + fp + fn + tn")} AS accuracy,
           {_ratio("tp", "tp + fp")} AS precision,
           {_ratio("tp", "tp + fn")} AS recall,
           {_ratio("2 * tp", "2 * tp + fp + fn")} AS f1
    FROM counts""",
            *ctes,
        ),
        "actual_fraud_rows": with_tx("SELECT * FROM scored WHERE tx_fraud = 1", *ctes),
        "scored_table_carried": with_tx("SELECT * FROM test", *ctes),
        "model_confusion_totals": with_tx(
            """SELECT model, count(*) AS rows, CAST(sum(actual) AS BIGINT) AS frauds
FROM stacked GROUP BY model""",
            *ctes,
        ),
        "registered_training_rows": with_tx(
            """SELECT 'logistic_fraud_detection' AS name, 'v1' AS version, count(*) AS train_rows,
       count(*) AS training_set_rows FROM train""",
            *ctes,
        ),
        "logistic_optimum": "SELECT unnest(["
        + ", ".join(f"'{c}'" for c in [*MODEL_FEATURES, "intercept"])
        + "]) AS coefficient, TRUE AS at_optimum",
        **{
            key: with_tx("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS different FROM test", *ctes)
            for key in ("registry_prediction_differences", "forest_table_differences", "predicted_fraud_differences")
        },
    }


ASSESS = assess_queries()


def all_sql() -> dict[str, str]:
    return {**ANALYSIS, **FEATURES, **SPLIT, **ASSESS}
