"""The driver contract in __spark_entry__.py."""

import re

import __spark_entry__ as entry


def test_entry_runs_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["day", "rating", "city", "revenue"]
    rows = df.collect()
    assert 0 < len(rows) <= 20
    revs = [r["revenue"] for r in rows]
    assert revs == sorted(revs, reverse=True)


def test_queries_and_oracles_line_up():
    q, o = entry.queries(), entry.oracle_sql()
    own = {k for k in q if k != "pipeline" and not re.match(r"op\d+_", k)}
    assert len(own) >= 90
    assert own <= set(o) <= set(q)
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip() for s in o.values())
