"""Every registered workload against its DuckDB oracle (small scale)."""

import pytest

from conftest import SF_SMALL

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con():
    from oracle import duck
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_matches_oracle(spark, con, name):
    from oracle import compare
    sql = oracle_sql().get(name)
    if sql is None:
        assert queries()[name](spark, SF_SMALL).count() >= 0
        return
    ok, n_spark, n_oracle, _secs, detail = compare(spark, con, name, queries()[name], sql, SF_SMALL)
    assert ok, detail


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["sk_id", "attr", "mod_dt", "data_src_cd", "is_current",
                          "eff_start_dt", "eff_end_dt"]
