"""Embedding near-dedup: random-hyperplane sign hashes, exact cosines, distributed connected components."""

import math

from pyspark.sql import functions as F

from harrow.llm import embedding_tasks as tasks
from harrow.llm.graph import components
from harrow.llm.store import written

COSINE = 0.95
MISSED = 2e-5  # of the pairs just at the threshold
BUCKET = 64  # rows of a bucket that the number of bits aims at
CHUNK = 1024  # rows of a chunk of a larger bucket
SEED = 7


def near_vectors(vectors, cosine=COSINE, missed=MISSED, bits=None, chunk=CHUNK, seed=SEED):
    """(vec_id, n_links, component_id, kept) for each row of vectors (vec_id long, embedding array of numbers).

    Two vectors of equal length link if their cosine, in double precision, is at
    least cosine. n_links counts the other rows linked directly, equal vectors
    included. component_id is the smallest vec_id reachable, and kept says that
    it is the row's own. A vector that is null, empty, zero or has a null or
    non-finite part links with nothing. A null vec_id links with nothing and is
    kept (component_id null). Rows of one vec_id and vector count one by one.

    A pair is found if all bits of one table agree. Bits grow with the logarithm
    of the number of different vectors, so buckets keep their size, and tables
    with the bits, so that a share of missed at most of the pairs just at the
    threshold, and far less above it, meets nowhere. Equal vectors are sent
    once, with their number.
    A bucket over chunk rows is dealt into chunks that meet two by two.
    """
    part = F.col("embedding")
    finite = F.forall(part, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = F.col("vec_id").isNotNull() & finite & F.exists(part, lambda x: x != 0)
    rows = vectors.select("vec_id", part.cast("array<double>").alias("embedding"))
    rows = rows.withColumn("embedding", F.when(sound, part))
    same = rows.where(part.isNotNull()).groupBy("embedding")
    same = written(same.agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")), "vectors")
    if bits is None:
        bits = max(2, (same.count() // BUCKET).bit_length())
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    tables = math.ceil(math.log(missed) / math.log(1 - agree))
    kind = "id long, n long, vector array<double>, codes array<long>, dim int"
    coded = same.select("id", "n", F.col("embedding").alias("vector"))
    coded = written(coded.mapInPandas(tasks.hasher(tables, bits, seed), kind), "codes")
    found = written(_blocks(coded, chunk).mapInPandas(tasks.linker(cosine), "id long, n long, other long"), "links")
    links = found.groupBy("id").agg(F.sum("n").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    named = same.join(links, "id", "left").join(groups, F.col("id") == F.col("node"), "left")
    named = named.select("embedding", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                         F.coalesce("component", "id").alias("component"))
    # vectors that link with nothing stay out of the join, where they would all be one key
    out = rows.where(part.isNotNull()).join(written(named, "classes"), "embedding", "left")
    out = out.unionByName(rows.where(part.isNull()), allowMissingColumns=True)
    component = F.coalesce("component", "vec_id").alias("component_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _blocks(coded, chunk):
    """Rows by bucket, larger buckets as pairs of chunks, in order of block."""
    placed = coded.select("id", "n", "vector", "codes", "dim", F.posexplode("codes").alias("table", "code"))
    slim = coded.select("dim", F.posexplode("codes").alias("table", "code"))
    bucket = ["dim", "table", "code"]
    sizes = slim.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.where("size > 1").select(*bucket, F.ceil(F.col("size") / chunk).cast("int").alias("chunks"))
    placed = placed.join(written(sizes, "sizes"), bucket)
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    placed = placed.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    block = F.concat_ws("|", *bucket, low, high)
    side = F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int"))
    placed = placed.select(block.alias("block"), side.alias("side"), "table", "id", "n", "vector", "codes")
    return placed.repartition("block").sortWithinPartitions("block", "id")


def op2_embedding_dedup(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.95),
n as (select a as vec_id, count(*) as n from l group by 1),
r(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from r join l on l.a = r.b),
c as (select a as vec_id, min(b) as component_id from r group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from embeddings left join n using (vec_id) join c using (vec_id)
"""
