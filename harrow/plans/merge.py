"""Ingest of registered feeds and their merge."""

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.operators import dedup, report
from harrow.operators.union import union_feeds
from harrow.session import stage_table
from harrow.sources import sinks

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Feed:
    """A named feed; ``read(spark)`` gives its listings."""

    name: str
    read: Callable


@dataclass(frozen=True)
class Merged:
    buffer: DataFrame
    table: DataFrame
    summary: DataFrame
    by_source: DataFrame
    failed: tuple


def merge(feeds, order):
    """Union of feed frames in their given order and its keep-first by name and
    source. ``order`` names the columns that order rows inside a feed."""
    ranked = [f.withColumn("_feed", F.lit(i)) for i, f in enumerate(feeds)]
    buffer = union_feeds(ranked)
    return buffer, dedup.keep_first_by_name_and_source(buffer, ["_feed", *order])


def ingest(spark, registry, order, folder=None, stamp=None):
    """Run each feed on its own, keep those that yield rows, merge them.

    Every feed is staged as a table, so one that fails, even late, is logged and
    left out, and none is computed twice. With ``folder`` the feeds and the
    merged table are written there too. Returns None where no feed yields rows.
    The frames of the result read the stages: a caller that opens a
    ``stage_scope`` around the run uses them inside it.
    """

    def run(feed):
        try:
            staged = stage_table(feed.read(spark), feed.name)
            if staged.isEmpty():
                log.warning("feed %s has no rows", feed.name)
                return None, False
            if folder:
                cells = staged.drop(*order)
                sinks.write_feed_csv(cells, folder, feed.name, stamp)
                sinks.write_feed_json(cells, folder, feed.name, stamp)
            return staged, False
        except Exception as error:  # a failing feed must not stop the others
            log.error("feed %s failed: %s", feed.name, error)
            return None, True

    with ThreadPoolExecutor(max(1, len(registry))) as pool:
        jobs = [pool.submit(copy_context().run, run, feed) for feed in registry]
        results = [job.result() for job in jobs]
    staged = [frame for frame, _ in results if frame is not None]
    failed = tuple(feed.name for feed, (_, bad) in zip(registry, results) if bad)
    if not staged:
        return None
    buffer, table = merge(staged, order)
    table = stage_table(table, "merged")  # read by each part of the result
    if folder:
        plain = ("_feed", *order)
        sinks.write_merged(table.drop(*plain), buffer.drop(*plain), folder, stamp)
    return Merged(
        buffer=buffer,
        table=table,
        summary=report.merge_summary(table),
        by_source=report.value_counts(table, "source"),
        failed=failed,
    )
