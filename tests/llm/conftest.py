import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from olapkit.llm.common import ship

    ship(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from rows (doc_id, text[, source]) with further columns whose names operators use themselves."""

    def make(rows, parts=2):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 7, None) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                         "row string, size int, score double")
        return df.repartition(parts) if rows else df

    return make


@pytest.fixture(scope="session")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
