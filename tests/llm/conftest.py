import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def table(spark):
    """table(rows, ddl) -> DataFrame over several partitions."""

    def make(rows, ddl):
        df = spark.createDataFrame(rows, ddl)
        return df.repartition(3) if rows else df

    return make


@pytest.fixture(scope="session")
def docs_of(table):
    """docs_of(texts) -> documents with ids from 0 and a clashing extra column or two."""

    def make(texts, source="s"):
        rows = [(i, t, "en", source, i, "x") for i, t in enumerate(texts)]
        return table(
            rows, "doc_id long, text string, lang string, source string, score int, row string"
        )

    return make


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
