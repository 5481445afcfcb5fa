"""Delimited files as records: every file read once, in ranges, by many tasks.

Files of any header and of any size are one scan. A large file is split into
byte ranges; a range does not know whether it begins inside a quoted cell, so
it is read under both assumptions (``record_tasks``) and gives a row that says
in which state it ends under each. Those few rows, in order, tell how each range
of a file really begins, and pick the records; records that cross ranges are
joined from their pieces. The result is one table of records as arrays of cells.
"""

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harrow.session import stage_table
from harrow.sources import record_tasks as tasks

QUOTE_OPEN, NO_HEADER, RAGGED = "quote left open", "no header", "row longer than header"
_PLACE = ("file", "block", "seq", "part")


@dataclass(frozen=True)
class Records:
    """``rows``: file, block, seq, part, cells of each record, headers left out; ``files``: file, header (cells, or
    NULL), width (cells of its longest row), reason (NULL where the file is sound)."""

    rows: DataFrame
    files: DataFrame


def _qualified(spark, paths):
    """Paths as scans give them: with the scheme of the default store where they have none."""
    fs = None
    for path in paths:
        if not re.match(r"\w+:", path):
            if fs is None:
                hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
                fs = hadoop.FileSystem.get(spark.sparkContext._jsc.hadoopConfiguration())
                root = fs.makeQualified(hadoop.Path("/")).toString().rstrip("/")
            path = root + path if path.startswith("/") else fs.makeQualified(hadoop.Path(path)).toString()
        yield tasks.one_slash(path)


def read(spark, paths):
    """Records of files by path; a file that cannot be read to its end has a reason, and the others are read."""
    paths = list(_qualified(spark, paths))
    packed = [p for p in paths if p.endswith(".gz")]
    plain = [p for p in paths if not p.endswith(".gz")]
    frames = []
    if plain:
        lines = spark.read.text(plain, lineSep="\n").select(
            F.col("value").cast("binary").alias("value"),
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        frames.append(lines.mapInArrow(tasks.split_text, tasks.SCHEMA))
    if packed:
        # not splittable, and only the bytes tell whether one is whole; a cell holds 2 GB at most
        whole = spark.read.format("binaryFile").load(packed).select("path", "content")
        frames.append(whole.mapInArrow(tasks.split_compressed, tasks.SCHEMA))
    table = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    table = stage_table(table, "records", compression="zstd")  # as large as the files
    listed = spark.createDataFrame([(p,) for p in paths], "file string")
    return Records(*_resolved(table, listed))


def _resolved(table, listed):
    ranges = table.where(F.col("kind") == tasks.RANGE)
    begins = _begins(ranges)
    own = begins.where(F.col("block").isNotNull())
    kinds = (tasks.LINE, tasks.QUOTED, tasks.RECORD, tasks.HEADER)
    # one row for each range: broadcast, as by file the rows of a large one would go through one task
    rows = table.where(F.col("kind").isin(*kinds)).join(F.broadcast(own), ["file", "block"])
    true = (F.col("under") == tasks.BOTH) | ((F.col("under") == tasks.IN) == F.col("open"))
    # where a range begins inside a cell, a line that would be a record is a piece of that cell
    rows = rows.where(true & ~F.coalesce(F.col("raw").isin("", "\r"), F.lit(False)))
    cells = F.when(F.col("kind") == tasks.LINE, F.split(F.regexp_replace("raw", r"\r$", ""), ","))
    cells = cells.when(F.col("kind") == tasks.QUOTED, F.split(F.expr("substring(raw, 2, length(raw) - 2)"), '","'))
    cells = cells.otherwise(F.col("cells"))
    rows = rows.select(*_PLACE, "kind", cells.alias("cells"), "width")
    left_open = begins.where(F.col("block").isNull() & F.col("open")).select("file", F.lit(QUOTE_OPEN).alias("left_open"))
    crossing = not own.where("open").isEmpty()  # one row for each range
    if crossing:
        rows = rows.unionByName(stage_table(_joined(table.join(left_open, "file", "left_anti"), own, true), "joined"))
    return _headed(rows, ranges, left_open, listed, crossing)


def _begins(ranges):
    """(file, block, open, origin): whether a range begins inside a cell, and the range in which that record began.

    A range ends the same way under both assumptions, or keeps the state that it
    begins in, or turns it round. So its end follows from the last range of the
    first kind and a prefix sum of the turns since. A row without a block has the
    state in which the file ends.
    """
    order = Window.partitionBy("file").orderBy("block")
    turns = F.sum((F.col("out_open") & ~F.col("in_open")).cast("long")).over(order)
    fixed = F.when(F.col("out_open") == F.col("in_open"), F.struct("out_open", "turns"))
    ends = ranges.select("file", "block", "out_open", "in_open", "in_through", turns.alias("turns"))
    ends = ends.select("file", "block", "in_through", "turns", F.last(fixed, ignorenulls=True).over(order).alias("fixed"))
    end = F.col("fixed.out_open") != ((F.col("turns") - F.col("fixed.turns")) % 2 == 1)
    ends = ends.select("file", "block", "in_through", end.alias("end"))
    ends = ends.withColumn("open", F.coalesce(F.lag("end").over(order), F.lit(False)))
    began = F.when(F.col("end") & ~(F.col("open") & F.col("in_through")), F.col("block"))
    ends = ends.withColumn("began", F.last(began, ignorenulls=True).over(order))
    begins = ends.select("file", "block", "open", F.lag("began").over(order).alias("origin"))
    last = ends.groupBy("file").agg(F.max_by("end", "block").alias("open"))
    none = F.lit(None).cast("long")
    return stage_table(begins.unionByName(last.select("file", none.alias("block"), "open", none.alias("origin"))), "begins")


def _joined(table, begins, true):
    """Records over several ranges: pieces joined in order, at the place where each record began."""
    pieces = table.where(F.col("kind").isin(tasks.TAIL, tasks.THROUGH, tasks.HEAD)).join(begins, ["file", "block"]).where(true)
    lines = table.where((F.col("kind") == tasks.LINE) & (F.col("under") == tasks.OUT)).join(begins.where("open"), ["file", "block"])
    pieces = pieces.unionByName(lines)
    begun = F.when(F.col("kind") == tasks.TAIL, F.col("block")).otherwise(F.col("origin"))
    whole = pieces.select("file", begun.alias("began"), F.struct("block", "seq", "raw").alias("piece")).groupBy("file", "began").agg(
        F.sort_array(F.collect_list("piece")).alias("pieces"))
    texts = whole.select("file", F.col("began").alias("block"), F.get("pieces", F.lit(0))["seq"].alias("seq"),
                         F.array_join(F.transform("pieces", lambda p: p["raw"]), "\n").alias("raw"))
    return texts.mapInArrow(tasks.split_joined, tasks.SCHEMA).select(*_PLACE, "kind", "cells", "width")


def _headed(rows, ranges, left_open, listed, crossing):
    """The first record of each file is its header."""
    headers = rows.where(F.col("kind") == tasks.HEADER).select("file", F.col("cells").alias("header"))
    longest = rows.where(F.col("kind") != tasks.HEADER).groupBy("file").agg(F.max("width").alias("width"))
    rows = rows.where(F.col("kind") != tasks.HEADER).drop("kind", "width")
    if crossing:
        # a header that does not end in its file's first range
        late = rows.where(F.col("block") == 0).join(headers, "file", "left_anti")
        late = late.groupBy("file").agg(F.min(F.struct("seq", "part", "cells")).alias("first"))
        late = stage_table(late.select("file", F.lit(0).cast("long").alias("block"), "first.*"), "headers")
        headers = headers.unionByName(late.select("file", F.col("cells").alias("header")))
        rows = rows.join(late, list(_PLACE), "left_anti")
    broken = ranges.groupBy("file").agg(F.max("reason").alias("reason"))
    files = listed.join(headers, "file", "left").join(longest, "file", "left").join(broken, "file", "left").join(left_open, "file", "left")
    files = files.select("file", "header", F.coalesce("width", F.lit(0)).alias("width"), F.coalesce(
        "reason", "left_open", F.when(F.col("header").isNull(), F.lit(NO_HEADER))).alias("reason"))
    return rows, files
