"""Every registered query against its SQL, on the small tables."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from workload import oracles, registry

QUERIES, ORACLES = registry.QUERIES, oracles.sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal(df.collect(), df.columns) == normal(result.fetchall(), columns)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["industry_id", "title", "nb_job_postings"] and df.limit(1).count() == 1
