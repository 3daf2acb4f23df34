"""The corpus queries against their SQL, and what the entry point registers."""

import pytest

import __spark_entry__ as entry
from conftest import SF0001
from oracle_compare import digest, duck


@pytest.mark.parametrize("key", ["op1_url_reputation", "op6_quality_votes", "op9_license_sentences", "op10_zip_warc", "op12_super_kmers", "op13_euler_tour"])
def test_matches_sql(spark, key):
    df, rel = entry.queries()[key](spark, SF0001), duck(SF0001).sql(entry.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    keys = entry.queries()
    assert all(sum(k.startswith(f"op{n}_") for k in keys) == 1 for n in range(1, 14))
    assert "pipeline" in keys
