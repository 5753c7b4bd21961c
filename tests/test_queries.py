"""Every registered query beside its SQL twin at the smallest scale."""

import duckdb
import pytest

from __spark_entry__ import entry
from checks.catalog import catalog as queries
from checks.oracles import oracles as oracle_sql
from tools.compare import TABLES, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return connection


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    ours = queries()[name](spark, SF).toPandas()
    assert difference(ours, db.sql(oracle_sql()[name]).df()) is None


def test_entry(spark):
    row = entry(spark).first()
    assert row.n_input > 0 and row.n_strict <= row.n_lenient
