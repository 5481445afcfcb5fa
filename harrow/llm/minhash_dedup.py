"""MinHash near-dedup: SuperMinHash signatures, banding, exact verification, union-find grouping."""

import math

from pyspark.sql import functions as F

from harrow.llm import minhash_tasks as tasks
from harrow.llm.graph import blocks, components
from harrow.llm.store import documents, maybe_broadcast, small_batches, written

SHINGLE = 5
PERCENT = 85
SLOTS, MISSED = 128, 5e-5  # ranks of a signature at most; share of the pairs at the threshold that may be missed
BLOCK = 1_000_000  # shingles that one block holds at most, but for a longer text


def banding(percent):
    """(bands, rows) that miss a pair at percent / 100 MISSED times at most; the longest bands that SLOTS ranks allow.

    Beyond 128 ranks the bands are as short as they can be, and as many as it takes.
    """
    for rows in range(16, 0, -1):
        same = (percent / 100) ** rows
        bands = 1 if same >= 1 else math.ceil(math.log(MISSED) / math.log1p(-same))
        if bands * rows <= SLOTS:
            break
    return bands, rows


def near_duplicates(docs, percent=PERCENT, k=SHINGLE, bands=None, rows=None, block=BLOCK):
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id long, text string).

    Documents link if their sets of k-word shingles have a Jaccard similarity of
    percent / 100 or more; bands and rows follow from percent unless both are
    given. component_id is the smallest doc_id reachable by
    links, and kept says that it is the row's own. A null or empty text and one
    of white space have an empty set and link with nothing. Rows that share a
    doc_id count as one document. A null doc_id links with nothing and is kept
    (component_id null). Extra columns are not read.

    Equal word sequences count once up to the last step, so a group of exact
    copies costs no more than one text. Candidates share a band of the
    signature; they are checked on full sets in blocks of bounded size.
    """
    if bands is None or rows is None:
        bands, rows = banding(percent)
    docs = docs.select("doc_id", "text")
    # a null id would turn the ids of its batch into floats
    named = docs.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), F.col("doc_id").isNull().alias("missing"), "text")
    signed = named.mapInPandas(
        tasks.signer(k, bands, rows), "doc_id long, missing boolean, fp binary, n_shingles long, bands array<long>")
    signed = written(signed.withColumn("doc_id", F.when(~F.col("missing"), F.col("doc_id"))).drop("missing"), "signed")
    texts = signed.where("n_shingles > 0 and doc_id is not null")
    # any row of an equal text stands for it; bands follow from fp
    firsts = texts.groupBy("fp").agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("n_shingles"))
    firsts = written(firsts, "firsts")
    reps = texts.join(firsts.select("id", "fp"), (texts["fp"] == firsts["fp"]) & (texts["doc_id"] == firsts["id"]))
    reps = reps.select("id", "bands")
    members = firsts.groupBy("id").agg((F.sum("n_shingles") + 64).alias("weight"))
    placed = blocks(members, reps.select(F.explode("bands").alias("bucket"), "id"), block)
    placed = written(placed, "blocks")
    ids = maybe_broadcast(written(placed.select("id").distinct(), "candidates"), 1_000_000)
    sought = docs.join(ids, docs["doc_id"] == ids["id"], "left_semi")
    sought = written(sought.distinct(), "sought")
    rows_in = placed.join(sought, placed["id"] == sought["doc_id"]).select("block", "doc_id", "text")
    rows_in = rows_in.repartition("block").sortWithinPartitions("block", "doc_id", "text")
    links = rows_in.mapInPandas(tasks.verifier(k, percent, 128, 0.15), "a long, b long")
    # equal texts under several ids, and several texts under one id
    groups = components(links)
    return _classes(signed, firsts, groups)


def _classes(signed, firsts, groups):
    named = firsts.join(groups, firsts["id"] == groups["node"], "left")
    named = named.select("fp", F.coalesce("component", "id").alias("component"))
    named = written(named, "classes")
    # texts without words have no fp: they spread by their ids, under keys longer than any fp
    own = F.concat(F.lit("no words in text "), F.col("doc_id").cast("string")).cast("binary")
    found = signed.withColumn("fp", F.coalesce("fp", own)).join(named, "fp", "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id"))
    found = found.select("doc_id", "n_shingles", component.cast("long").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op4_minhash_dedup(spark, sf_dir):
    small_batches(spark)
    return near_duplicates(documents(spark, sf_dir), PERCENT)


SQL = """
with recursive d as (
  select doc_id, list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents),
s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as x from d),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b using (x) where a.doc_id <> b.doc_id group by 1, 2),
e as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 85 * (na.n + nb.n - k)),
r(a, b) as (select doc_id, doc_id from documents union select r.a, e.b from r join e on e.a = r.b),
c as (select a as doc_id, min(b) as component_id from r group by a)
select doc_id, coalesce(n.n, 0) as n_shingles, component_id, doc_id = component_id as kept
from documents left join n using (doc_id) join c using (doc_id)
"""
