"""Small looks at a feed."""

from pyspark.sql import functions as F


def preview(df, columns, order, rows=5):
    """First rows in feed order (a top-k: no full sort)."""
    return df.orderBy(*order).limit(rows).select(*columns)


def short_name(c):
    return F.substring(c, 1, 65)


def elided(c, size=100):
    """First characters followed by an ellipsis, whatever the length."""
    return F.concat(F.substring(F.coalesce(c, F.lit("nan")), 1, size), F.lit("..."))
