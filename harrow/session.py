"""Session settings and the shared folder for staged tables."""

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_STAGE_KEY = "spark.checkpoint.dir"
_made = ContextVar("stages made in the open scope", default=None)


def local_session(cores="*", name="harrow", **conf):
    """A session for tests and benchmarks on one machine."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        # pages are large cells: small Arrow batches keep Python workers small
        "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
        # no call-site capture per column call: plans are built faster
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stage_dir(spark):
    """Shared folder for staged tables, as the cluster names it.

    Only a single-machine session may go without the setting; it gets a folder
    of its own.
    """
    folder = spark.conf.get(_STAGE_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_STAGE_KEY} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="harrow-")
    spark.conf.set(_STAGE_KEY, folder)
    return folder


@contextmanager
def stage_scope(spark):
    """Owns the stages made inside: they are deleted at its end, also after a failure.

    What is returned from it must not read them any more. Scopes may be nested;
    each owns its own. A thread started inside sees the scope only if it runs in
    a copy of the context.
    """
    made = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in made:
            path = hadoop.Path(path)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage_path(spark, name):
    path = f"{stage_dir(spark)}/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


def stage_table(df, name, **options):
    """Write a frame to the shared folder, with the writer's options, and read it back.

    Cuts the lineage: what follows reads the files, so a lost executor costs a
    re-read and not the work before.
    """
    path = stage_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
