"""Compare ``queries()`` against ``oracle_sql()`` the way the driver does: row count,
column names, and an order-insensitive hash of the values (columns sorted by name).

    python tests/oracle_compare.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v) + 0.0)  # -0.0 and 0.0 are the same value
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def compare(spark, sf_dir: str, keys: list[str] | None = None, verbose: bool = True):
    import __spark_entry__ as e

    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            s_rows = [tuple(r) for r in sdf.collect()]
            s_cols = [c.lower() for c in sdf.columns]
        except Exception as ex:  # noqa: BLE001
            results[k] = ("spark-error", str(ex)[:400])
            if verbose:
                print(f"{k:28s} SPARK ERROR {str(ex)[:400]}")
            continue
        t1 = time.time()
        if k not in sqls:
            results[k] = ("rows-only", len(s_rows))
            if verbose:
                print(f"{k:28s} rows-only {len(s_rows)} rows  spark {t1 - t0:.1f}s")
            continue
        try:
            rel = con.sql(sqls[k])
            d_cols = [c.lower() for c in rel.columns]
            d_rows = rel.fetchall()
        except Exception as ex:  # noqa: BLE001
            results[k] = ("oracle-error", str(ex)[:400])
            if verbose:
                print(f"{k:28s} ORACLE ERROR {str(ex)[:400]}")
            continue
        ok_cols = sorted(s_cols) == sorted(d_cols)
        sn, sh = digest(s_cols, s_rows)
        dn, dh = digest(d_cols, d_rows)
        ok = ok_cols and sn == dn and sh == dh
        results[k] = ("match" if ok else "MISMATCH", sn, dn)
        if verbose:
            print(
                f"{k:28s} {'match' if ok else 'MISMATCH'} rows {sn}/{dn} cols_ok={ok_cols} "
                f"spark {t1 - t0:.1f}s"
            )
            if not ok_cols:
                print("   spark cols:", sorted(s_cols), "\n   duck cols: ", sorted(d_cols))
            elif not ok:
                _show_diff(s_cols, s_rows, d_cols, d_rows)
    return results


def _show_diff(s_cols, s_rows, d_cols, d_rows, n=5):
    order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    ss = {repr(tuple(_norm(r[i]) for i in order_s)) for r in s_rows}
    ds = {repr(tuple(_norm(r[i]) for i in order_d)) for r in d_rows}
    print("   cols:", [s_cols[i] for i in order_s])
    for x in sorted(ss - ds)[:n]:
        print("   spark only:", x)
    for x in sorted(ds - ss)[:n]:
        print("   duck only: ", x)


if __name__ == "__main__":
    from txengine.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("match", "rows-only")]
    print("NOT OK:", bad)
