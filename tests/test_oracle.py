"""Every query beside its SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in ORACLE:
        assert rows
        return
    theirs = con.execute(ORACLE[name]).fetchall()
    columns = [column[0] for column in con.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, rows) == rows_of(columns, theirs)


def test_flagship(spark):
    rows = {(r.verification_status, r.quality_score): r.records for r in entry.entry(spark).collect()}
    assert sum(rows.values()) == 150 and rows[("VERIFIED", 1.0)] == 63
