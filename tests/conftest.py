import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from olapkit.session import JOB_CONF, LOCAL_CONF, configure

    scratch = tempfile.mkdtemp(prefix="olapkit-test-")
    b = (SparkSession.builder.master("local[4]").appName("olapkit-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.warehouse.dir", f"{scratch}/warehouse"))
    for k, v in {**LOCAL_CONF, **JOB_CONF}.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="olapkit-t-")


@pytest.fixture(scope="session")
def tables(spark):
    from olapkit.sources.readers import Tables

    return Tables(spark, SF_SMALL)


def rows_of(df, cols=None):
    cols = cols or df.columns
    got = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(got, key=lambda row: tuple((v is None, "" if v is None else v) for v in row))


def plan_text(df, mode="formatted"):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
