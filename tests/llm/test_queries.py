"""Every query with SQL against that SQL, on the smallest tables."""

import os

import duckdb
import pytest

from harrow.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted(repr([cell(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        db.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    cursor = db.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert rows_of(found.columns, found.collect()) == rows_of(columns, expected)
