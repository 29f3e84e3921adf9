"""Every registered job against its DuckDB statement on the smallest tables."""

import duckdb
import pytest

from olapkit import plans
from tools.oracle_check import TABLES, canon

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(plans.oracle_sql()))
def test_matches_oracle(spark, con, key):
    df = plans.queries()[key](spark, SF_SMALL)
    srows = df.collect()
    rel = con.sql(plans.oracle_sql()[key])
    dcols = [c.lower() for c in rel.columns]
    drows = rel.fetchall()
    assert sorted(c.lower() for c in df.columns) == sorted(dcols)
    assert canon(srows, [c.lower() for c in df.columns]) == canon(drows, dcols)


def test_every_query_has_an_oracle():
    assert set(plans.queries()) == set(plans.oracle_sql())
