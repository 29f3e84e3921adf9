"""Every operator with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from olapkit.llm import queries
from tools.oracle_check import canon

from ..conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    r = con.execute(queries.ORACLE_SQL[name])
    cols = [c[0] for c in r.description]
    assert sorted(cols) == sorted(df.columns)
    assert canon(df.collect(), df.columns) == canon(r.fetchall(), cols)
