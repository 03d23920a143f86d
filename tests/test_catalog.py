"""Every registered query against its DuckDB oracle, and the driver contract."""

import re
import pytest

from conftest import SMALL_SF
from oracle_compare import compare, duck
from ticketlens.plans.catalog import ORACLE, QUERIES, ROWS_ONLY

import __spark_entry__ as entry_mod


@pytest.fixture(scope="module")
def con():
    return duck(SMALL_SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, name, SMALL_SF, con)
    assert result["status"] in ("match", "rows-only"), result


def test_contract_keys():
    qs = entry_mod.queries()
    oracle = entry_mod.oracle_sql()
    assert set(oracle) <= set(qs)
    ours = {k for k in qs if not re.match(r"op[0-9]+_|pipeline$", k)}
    assert ours - set(oracle) == set(ROWS_ONLY)
    assert set(ORACLE) == {k for k in oracle if k in ours}


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["fiscal_year", "violation_code", "frequency", "rnk"]
    assert len(df.collect()) > 0
