"""Every registered query against its SQL on the smallest tables."""

import importlib.util
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from harrow.checks import fixtures

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

_spec = importlib.util.spec_from_file_location("contract", f"{ROOT}/__spark_entry__.py")
contract = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(contract)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def _normal(rows):
    def cell(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(cell(v) for v in r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("key", contract.queries())
def test_query_matches_sql(spark, duck, key):
    df = contract.queries()[key](spark, SF)
    columns = sorted(df.columns)
    got = _normal(df.select(*columns).collect())
    if key not in contract.oracle_sql():
        assert got
        return
    result = duck.execute(contract.oracle_sql()[key])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == _normal([tuple(r[i] for i in order) for r in result.fetchall()])


def test_entry(spark):
    assert contract.entry(spark).count() == 5


def test_given_tables_are_dealt_without_a_sort(spark, tmp_path):
    """A plain repartition sorts all rows of a scan task first; parts grow in number with the table."""
    spark.range(50, numPartitions=1).withColumnRenamed("id", "o_orderkey").write.parquet(str(tmp_path / "orders.parquet"))
    dealt = fixtures.table(spark, str(tmp_path), "orders")
    assert "RoundRobin" not in dealt._jdf.queryExecution().executedPlan().toString()
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == spark.sparkContext.defaultParallelism and sum(r["count"] for r in sizes) == 50
