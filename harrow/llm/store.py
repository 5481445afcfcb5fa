"""Tables in the folder that all executors share, to cut lineage and to be read more than once."""

import tempfile
import uuid

from pyspark.sql import functions as F

_KEY = "spark.checkpoint.dir"


def shared_folder(spark):
    """The folder that spark.checkpoint.dir names.

    Only a session on one machine may go without it; it then gets a folder of
    its own, as in tests.
    """
    folder = spark.conf.get(_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {_KEY} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="harrow-llm-")
        spark.conf.set(_KEY, folder)
    return folder.rstrip("/")


def written(df, name):
    """The frame, written once to the shared folder and read back.

    What follows reads the files: a lost executor costs a re-read, not the work
    before. An empty frame keeps its schema.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def maybe_broadcast(table, rows):
    """A hint to broadcast a narrow written table, given only if it has at most so many rows; joins shuffle beyond."""
    return F.broadcast(table) if table.count() <= rows else table


def small_batches(spark, rows=1000):
    """Send whole texts to Python in smaller Arrow batches, unless the session asks for fewer rows already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, rows)
