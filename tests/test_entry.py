"""Every registered query against its SQL counterpart in another engine."""

import glob
import os

import duckdb
import pytest
from helpers import rows

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


class Result:
    """Rows of the other engine, read through a view, columns sorted by name."""

    def __init__(self, connection, sql):
        done = connection.sql(sql)
        done.create_view("result", replace=True)
        done = connection.execute("SELECT * FROM result")
        self.columns = sorted(c[0] for c in done.description)
        order = sorted(range(len(done.description)), key=lambda i: done.description[i][0])
        self.data = [tuple(r[i] for i in order) for r in done.fetchall()]

    def collect(self):
        return self.data


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, engine, name):
    got = QUERIES[name](spark, FOLDER)
    want = Result(engine, ORACLE[name])
    assert sorted(got.columns) == want.columns
    assert rows(got.select(*want.columns)) == rows(want)
    assert want.data


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_sql_belongs_to_queries():
    assert set(ORACLE) <= set(QUERIES)


def test_flagship(spark):
    assert entry_points.entry(spark).count() == 4984
