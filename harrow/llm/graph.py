"""Connected components by alternating star contraction, and blocks of rows that may be linked."""

from pyspark.sql import functions as F

from harrow.llm.store import maybe_broadcast, written

_SMALL = 1_000_000  # rows of two longs


def components(edges):
    """(node, component): the smallest node that each node of the edges reaches.

    edges has long columns a and b. Every round points each node's larger
    neighbours at its smallest one, then the smaller ones at the smallest; the
    number of rounds grows with the logarithm of the longest path. Smallest
    neighbours are found by an aggregation that combines in each task, and no
    adjacency list is ever gathered, so a node with very many neighbours is
    like any other. Edges with a null and loops are left out; nodes without
    edges do not appear.
    """
    pairs = _ordered(edges.select("a", "b"))
    pairs = written(pairs, "edges")
    state = _state(pairs)
    while state[0]:
        pairs = written(_small_star(_large_star(pairs)), "edges")
        before, state = state, _state(pairs)
        if state == before:
            break
    found = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def _ordered(edges):
    """Each edge once, the larger node first."""
    edges = edges.where(F.col("a") != F.col("b"))
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(pairs):
    mix = F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))
    return tuple(pairs.agg(F.count(F.lit(1)), mix).first())


def _large_star(pairs):
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    least = written(least, "least")  # a table, so that the join can split a node with very many neighbours
    larger = pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))  # the larger neighbours v of each u
    return _ordered(larger.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(pairs):
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    least = written(least, "least")
    moved = pairs.withColumnRenamed("a", "u").join(least, "u").select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.unionByName(kept))


def blocks(members, buckets, limit):
    """(block, id): groups of at most about `limit` weight in which all links are to be sought.

    members: id, weight; buckets: bucket, id. Ids that share buckets, directly
    or through others, form a family, and a family within the limit is one
    block: each of its ids is sent once, not once for each bucket. The ids of a
    larger family go by their buckets; a bucket over the limit is dealt into
    chunks, and each two chunks meet in a block. So every two ids of a bucket
    meet, and no task gets an unbounded group.
    """
    buckets = buckets.select("bucket", "id")
    hubs = buckets.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("top"))
    hubs = written(hubs.where(F.col("hub") != F.col("top")).select("bucket", "hub"), "hubs")
    # from here on only buckets of two ids or more
    buckets = written(buckets.join(maybe_broadcast(hubs, _SMALL), "bucket").distinct(), "buckets")
    families = components(buckets.select(F.col("hub").alias("a"), F.col("id").alias("b")))
    families = families.select(F.col("node").alias("id"), F.col("component").alias("family"))
    placed = written(families.join(members.select("id", "weight"), "id"), "families")
    sizes = placed.groupBy("family").agg(F.sum("weight").alias("total"))
    large = written(sizes.where(F.col("total") > limit).select("family"), "large")
    small = placed.join(large, "family", "left_anti")
    whole = small.select(F.concat(F.lit("f"), F.col("family").cast("string")).alias("block"), "id")
    dealt = buckets.select("bucket", "id").join(placed.join(large, "family", "left_semi").select("id", "weight"), "id")
    dealt = written(dealt, "dealt")
    chunks = dealt.groupBy("bucket").agg(F.ceil(F.sum("weight") / limit).cast("int").alias("chunks"))
    dealt = dealt.select("bucket", "id").join(written(chunks, "chunks"), "bucket")
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    pair = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = dealt.select("bucket", "id", own.alias("c"), pair.alias("d"))
    name = F.concat_ws("|", F.lit("b"), "bucket", F.least("c", "d"), F.greatest("c", "d"))
    return whole.unionByName(dealt.select(name.alias("block"), "id"))
