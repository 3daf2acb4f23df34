"""Amounts without a fixed scale: totals keep every digit and never abort."""

import datetime as dt
import math

import pytest

from txengine.plans import analysis, calendar
from txengine.sources.schema import TX_SCHEMA

DAY0 = dt.datetime(2024, 1, 1)


def _tx(spark, amounts):
    rows = [
        (i, DAY0 + dt.timedelta(days=i % 3, seconds=i), 1 + i % 2, 5, a, 0, 0, 0, 0)
        for i, a in enumerate(amounts)
    ]
    return spark.createDataFrame(rows, TX_SCHEMA)


def _close(got, want):
    if want is None or math.isnan(want):
        return got is None if want is None else math.isnan(got)
    return got == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize(
    "amounts",
    [
        [0.004] * 1000,
        [0.125, 0.375, 1e17, -1e17, 12.34],
        [1e-8, 2e-8, 3.0],
        [1e300, 1.5],
        [float("nan"), 2.5],
        [None, 0.1, 0.2],
        [None, None],
    ],
)
def test_totals_follow_plain_sums(spark, amounts):
    tx = _tx(spark, amounts)
    there = [a for a in amounts if a is not None]
    want = math.fsum(there) if there and not any(math.isnan(a) for a in there) else (math.nan if there else None)
    row = analysis.amount_summary(tx).first()
    assert _close(row["total_amount"], want)
    assert _close(row["avg_amount"], want / len(there) if there else None)
    assert _close(analysis.amount_by_scenario(tx).first()["total_amount"], want)
    assert _close(analysis.avg_by_scenario(tx).first()["avg_amount"], want / len(there) if there else None)
    analysis.top_spenders(tx).collect()
    run = {r["transaction_id"]: r for r in calendar.customer_running_day(tx).collect()}
    assert len(run) == len(amounts)


def test_small_amounts_are_not_lost(spark):
    tx = _tx(spark, [0.004] * 1000)
    assert analysis.amount_summary(tx).first()["total_amount"] == 4.0
    assert {r["total_spend"] for r in analysis.top_spenders(tx).collect()} == {2.0}
    mean = {r["column_name"]: r["mean"] for r in analysis.numeric_describe(_tx(spark, [1e-8, 3e-8])).collect()}
    assert mean["tx_amount"] == pytest.approx(2e-8, rel=1e-12)


def test_no_digit_of_the_deviation_depends_on_the_partitions(spark):
    """Amounts of very different size, dealt in many ways; and what exact rationals give."""
    import math
    import random
    from fractions import Fraction

    rng = random.Random(7)
    amounts = [round(rng.uniform(0, 1) * 10 ** rng.randrange(0, 11), 6) for _ in range(3000)] + [None, 0.0, -12.5]
    tx = _tx(spark, amounts)
    seen = set()
    for parts in (1, 2, 7, 40):
        rows = analysis.numeric_describe(tx.repartition(parts)).collect()
        seen.add(tuple(sorted((r["column_name"], r["count"], r["mean"], r["stddev"]) for r in rows)))
    assert len(seen) == 1
    known = [Fraction(f"{a:.6f}") for a in amounts if a is not None]
    mean = sum(known) / len(known)
    want = math.sqrt(sum((x - mean) ** 2 for x in known) / (len(known) - 1))
    got = {c: (n, m, sd) for c, n, m, sd in seen.pop()}["tx_amount"]
    assert got[0] == len(known) and math.isclose(got[2], want, rel_tol=1e-12)
    fine = {r["column_name"]: r for r in analysis.numeric_describe(_tx(spark, [1e-8, 3e-8])).collect()}
    assert math.isclose(fine["tx_amount"]["stddev"], math.sqrt(2) * 1e-8, rel_tol=1e-9)
    none = {r["column_name"]: r for r in analysis.numeric_describe(tx.limit(0)).collect()}
    assert len(none) == 8 and all(r["count"] == 0 and r["stddev"] is None for r in none.values())
    one = {r["column_name"]: r for r in analysis.numeric_describe(_tx(spark, [5.0])).collect()}
    assert one["tx_amount"]["stddev"] is None and one["tx_amount"]["mean"] == 5.0
