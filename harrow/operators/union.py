"""Union of feeds with differing columns."""

from functools import reduce


def union_feeds(feeds):
    """UNION ALL by column name; a column a feed lacks is NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), feeds)
