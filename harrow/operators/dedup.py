"""Keep-first deduplication."""

from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F

from harrow.session import stage_table


def keep_first(df, keys, order, copies=None):
    """First row per key in the given order; NULL keys equal each other.

    Each task first reduces its rows to one per key, so a key that holds a third
    of the table sends one row per task through the shuffle. ``order`` must be
    unique per row for a stable result. ``copies`` names an extra column with
    the number of rows behind each kept one; with it the first row is a
    ``min_by`` in the same aggregation as the count, without it the ranking's
    group limit, which does not pack the row.
    """
    if not copies:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn("_place", place).where(F.col("_place") == 1).select(*df.columns)
    rest = [c for c in df.columns if c not in keys]
    position = F.struct(*order) if len(order) > 1 else F.col(order[0])
    first = F.min_by(F.struct(*rest), position).alias("_first")
    kept = df.groupBy(*keys).agg(first, F.count(F.lit(1)).alias(copies))
    columns = [F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns]
    return kept.select(*columns, copies)


def keep_first_staged(df, keys, order, copies):
    """As ``keep_first`` with ``copies``, of rows that come from a staged table, which is read twice.

    The columns of ``order`` are never NULL and together unique per row; the last
    one is a number. First the place of each key's first row is found: the
    smallest last column for each key and value of the other ones goes by hash,
    so no row is packed or sorted and a task's memory grows with its keys. The
    places are staged, so that few are broadcast, and pick the rows before
    anything else of them is worked out.
    """
    *leading, last = order
    ends = df.groupBy(*keys, *leading).agg(F.min(last).alias(last), F.count(F.lit(1)).alias(copies))
    places = ends.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_at"), F.sum(copies).alias(copies))
    places = places.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], "_at.*", copies)
    places = stage_table(places, "places")
    kept = df.join(places.select(*order), list(order), "left_semi").select(*df.columns)
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)))
    return kept.join(places.drop(*order), same).select(*df.columns, copies)


def keep_first_by_name(df, order, copies=None, staged=False):
    """First per name. Keeping the first per (name, source) beforehand changes
    nothing under one fixed order, so it is a single shuffle."""
    return keep_first_staged(df, ["name"], order, copies) if staged else keep_first(df, ["name"], order, copies)


def keep_first_by_name_and_source(df, order, copies=None):
    return keep_first(df, ["name", "source"], order, copies)


def keep_first_in_feed(df, order, key="name"):
    """First per key value inside each feed (source)."""
    return keep_first(df, ["source", key], order)


def first_seen_links(links, order):
    """Each link once, at the place where it is first seen."""
    return keep_first(links, ["link"], order)
