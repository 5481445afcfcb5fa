"""Feed files: discovery by name, header-aware CSV reading, load order."""

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.operators.conform import map_null_tokens
from harrow.session import stage_table
from harrow.sources import records
from harrow.sources.record_tasks import file_path

log = logging.getLogger(__name__)

# --- fixed values: which file names belong to which chain -------------------
LOAN_NAMES = (("loan", "dai", "institution"), ("scholarship",))
SCHOLARSHIP_NAMES = (("scholarship",), ("loan",))
OUTPUT_NAMES = ("loans_cleaned", "scholarships_cleaned")
# ----------------------------------------------------------------------------

# columns that give the load order: file by name, then place inside the file.
# A large file read in blocks keeps its order through the block start.
LOAD_ORDER = ("_file", "_block", "_row")

_LOGGED = 1000  # files left out that are named in the log
_PART = r"^(.*\.csv)/part-[^/]*$"  # a part of a feed that Spark wrote as a folder


def _wanted(name, rule, exclude_outputs):
    low = name.lower()
    some, none = rule
    if not name.endswith(".csv") or not any(w in low for w in some) or any(w in low for w in none):
        return False
    return not (exclude_outputs and low.startswith(OUTPUT_NAMES))


def _fs(spark, path):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def size(spark, path):
    """Bytes of a file, or of all files of a folder."""
    fs, path = _fs(spark, path)
    return fs.getContentSummary(path).getLength()


def parts(spark, folder):
    """Part files of a folder that Spark wrote, in order."""
    fs, path = _fs(spark, folder)
    names = [s.getPath() for s in fs.listStatus(path)]
    return sorted(p.toString() for p in names if p.getName().startswith("part-"))


def listing(spark, folder):
    """Paths of all files of a folder and of the folders in it, empty ones too; tasks list where there are many folders."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return [file_path(uri) for uri in found.inputFiles()]


def discover(spark, folder, rule, exclude_outputs=False):
    """Paths of the feed files of a folder, by name. A feed may be one file or
    a folder of part files as Spark writes it."""
    fs, path = _fs(spark, folder)
    if not fs.exists(path):
        return []
    root = fs.getFileStatus(path).getPath().toString().rstrip("/")
    found = []
    for file in listing(spark, folder):
        name, *below = file[len(root) + 1:].split("/")
        part = not below or len(below) == 1 and below[0].startswith("part-")
        if part and _wanted(name, rule, exclude_outputs):
            found.append(file)
    return sorted(found)


def _unique(names):
    """Blank and repeated column names get a number."""
    seen, out = {}, []
    for i, name in enumerate(names):
        name = name or f"Unnamed: {i}"
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(f"{name}.{n}" if n else name)
    return tuple(out)


@dataclass(frozen=True)
class Feeds:
    """``table``: the rows of all sound feeds (None where there is none); ``rejected``: (file, reason) of those left out."""

    table: DataFrame | None
    rejected: DataFrame


def read_feeds(spark, paths, skip_ragged=True):
    """Feed files with differing headers in one scan, all columns as text.

    The header, the rows and the verdict on each file come from the same read.
    A file is left out as a whole where it is not UTF-8 to its end, where a
    compressed one is cut or broken, where a quoted cell is never closed, and
    (``skip_ragged``) where a row is longer than its header; of a feed that Spark
    wrote as a folder, all parts are then left out. A file without any record
    has no header and no rows. Blank lines are skipped, missing cells are NULL.

    Cells find their column through the positions that their header gives, so
    the plan grows with the number of columns and not with that of headers.
    """
    if not paths:
        return Feeds(None, spark.createDataFrame([], "file string, reason string"))
    read = records.read(spark, paths)
    files = read.files.withColumn("feed", F.coalesce(F.nullif(F.regexp_extract("file", _PART, 1), F.lit("")), F.col("file")))
    if skip_ragged:
        ragged = F.when(F.col("width") > F.size("header"), F.lit(records.RAGGED))
        files = files.withColumn("reason", F.coalesce("reason", ragged))
    files = stage_table(files.select("file", "feed", "header", "reason"), "files")
    # a part without a record takes nothing from its feed
    broken = files.where(F.col("reason").isNotNull() & (F.col("reason") != records.NO_HEADER))
    broken = broken.groupBy("feed").agg(F.min("reason").alias("feed_reason"))
    files = files.join(broken, "feed", "left").select("file", "header", F.coalesce("reason", "feed_reason").alias("reason"))
    rejected = files.where(F.col("reason").isNotNull()).select("file", "reason")
    for row in rejected.limit(_LOGGED).collect():
        log.error("skipped %s: %s", row["file"], row["reason"])
    sound = files.where(F.col("reason").isNull())
    headers = sound.groupBy("header").agg(F.min("file").alias("first")).orderBy("first").collect()
    if not headers:
        return Feeds(None, rejected)
    names = [_unique(h["header"]) for h in headers]
    columns = list(dict.fromkeys(c for own in names for c in own))
    at = [{c: k for k, c in enumerate(own)} for own in names]
    places = [(i, h["header"], [own.get(c, -1) for c in columns]) for i, (h, own) in enumerate(zip(headers, at, strict=True))]
    # a row for each different header
    places = spark.createDataFrame(places, "which int, header array<string>, places array<int>")
    # a number for each file, and the places of each header: broadcast, so that no row is shuffled and a large file stays dealt out
    which = sound.join(F.broadcast(places), "header").select("file", "which")
    placed = read.rows.join(F.broadcast(which), "file").join(F.broadcast(places.drop("header")), "which")
    cells = [F.get("cells", F.get("places", F.lit(i))).alias(c) for i, c in enumerate(columns)]
    place = (F.col("file").alias("_file"), F.col("block").alias("_block"), (F.shiftleft("seq", 24) + F.col("part")).alias("_row"))
    return Feeds(map_null_tokens(placed.select(*cells, *place), keep=LOAD_ORDER), rejected)


def rejected_files(spark, paths):
    """(file, reason) of every file that ``read_feed_files`` leaves out as a whole."""
    return read_feeds(spark, paths).rejected


def read_feed_files(spark, paths, skip_ragged=True):
    """The rows of ``read_feeds``: union of feed files, or None where nothing can be read."""
    return read_feeds(spark, paths, skip_ragged).table


def load_loan_feeds(spark, folder, exclude_outputs=False, **options):
    """All loan feeds of a folder with their load order, or None."""
    return read_feed_files(spark, discover(spark, folder, LOAN_NAMES, exclude_outputs), **options)


def load_scholarship_feeds(spark, folder, exclude_outputs=False, **options):
    return read_feed_files(spark, discover(spark, folder, SCHOLARSHIP_NAMES, exclude_outputs), **options)
