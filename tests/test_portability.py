"""Registered outputs compare equal through pandas on both engines
(Spark ``toPandas`` vs DuckDB ``.df()``), not only row by row."""

import pandas as pd
import pytest

from conftest import SMALL_SF
from oracle_compare import duck
from ticketlens.plans.catalog import DATE_COLUMNS, NULLABLE_INT_COLUMNS, ORACLE, QUERIES


def _as_text(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)]
    return sorted("|".join("" if pd.isna(v) else str(v) for v in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    return duck(SMALL_SF)


@pytest.mark.parametrize("name", sorted(set(DATE_COLUMNS) | set(NULLABLE_INT_COLUMNS) | {"average_fine", "freq_body"}))
def test_pandas_text_equal(spark, con, name):
    s = QUERIES[name](spark, SMALL_SF).toPandas()
    d = con.execute(ORACLE[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert _as_text(s) == _as_text(d)
