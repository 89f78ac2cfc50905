"""Every registered query against the same question in DuckDB.

``CHRONOLOOM_SF`` picks the data folder, sf0.001 by default.
"""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as job

SF = os.environ.get("CHRONOLOOM_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_names_agree():
    assert set(job.oracle_sql()) <= set(job.queries())


@pytest.mark.parametrize("name", sorted(job.queries()))
def test_query(spark, duck, name):
    got = job.queries()[name](spark, SF)
    rows = got.collect()
    if name not in job.oracle_sql():
        assert rows
        return
    want = duck.sql(job.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    ours, theirs = in_order(got.columns, rows), in_order(want.columns, want.fetchall())
    assert len(ours) == len(theirs) > 0
    wrong = [pair for pair in zip(ours, theirs) if repr(pair[0]) != repr(pair[1])]
    assert not wrong[:3]
    kinds = dict(zip(want.columns, map(str, want.types)))
    known = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    assert {f.name: known.get(f.dataType.simpleString(), "BOOLEAN") for f in got.schema.fields} == kinds


def test_entry(spark):
    assert job.entry(spark).count() > 0
