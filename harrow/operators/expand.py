"""Listings made from dimension rows by templates."""

from pyspark.sql import functions as F

from harrow.schema import COMMON


def expand_dimension(dimension, templates, constants, order):
    """One listing per dimension row.

    ``templates`` maps a listing column to a ``format_string`` template and the
    dimension columns it takes; ``constants`` holds the fixed columns.
    """
    columns = {c: F.format_string(t, *[F.col(a) for a in args]) for c, (t, args) in templates.items()}
    columns.update({c: F.lit(v) for c, v in constants.items()})
    out = dimension.select(*[v.alias(c) for c, v in columns.items()], *[F.col(o) for o in order])
    present = [c for c in COMMON if c in out.columns]
    return out.select(*present, *order)
