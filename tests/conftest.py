import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from harrow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Run a column function over a list of texts."""
    from pyspark.sql import functions as F

    def run(function, texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r[0] for r in rows.select(function(F.col("t")), "i").orderBy("i").collect()]

    return run
