"""Resampling towards a target distribution: hashed word runs of distinct lines are counted once."""

import builtins

from pyspark.sql import Window
from pyspark.sql import functions as F

from harrow.llm.store import documents, written

GRAMS = 1  # words of the longest run
BUCKETS = 10_000
PERCENT = 10  # of the documents with enough words
LEAST_WORDS = 20
SEED = 2024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAKS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"  # all but the line end


def resample(docs, target, grams=GRAMS, buckets=BUCKETS, percent=PERCENT, least=LEAST_WORDS, seed=SEED):
    """(doc_id, n_features, weight, score, rank), all longs, one row for each row of docs; rank is null where not drawn.

    Words are runs of digits, letters and non-ASCII characters, A-Z lowered; a
    document's features are all runs of 1 to `grams` words, each in the bucket
    of its crc32. A bucket's gain is 1000 times the log of how much more often
    the texts of target have it than docs, smoothed by 1, rounded down. weight
    sums the gains of a document's features; score adds Gumbel noise drawn from
    the doc_id and the seed. Of the documents with `least` words or more the
    given percent with the highest scores are drawn; ties go to the smaller
    doc_id, then to a hash of the text. A null, empty or wordless text has no
    feature and weight 0; a null doc_id is read as '' by the noise and is the
    smallest id. Each of several equal rows has its own rank. Only doc_id and
    text are read, and text of target.

    Line ends part words, so a text is cut there: a line that stands many times
    is hashed once, its counts times its occurrences; runs over a line end are
    counted apart. The gains, one for each bucket, are all that the driver sees.
    """
    keyed = docs.select("doc_id", F.xxhash64(F.col("doc_id").isNull(), "text").alias("mark"), _lines("text").alias("lines"))
    spread = keyed.select("doc_id", "mark", F.explode_outer("lines").alias("line"))
    placed = spread.select("doc_id", "mark", *_names())
    lines = spread.where("line is not null").groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    words = F.split("line", " ")
    lines = lines.select(*_names(), "n", F.size(words).alias("n_words"), _features(words, grams, buckets).alias("features"))
    lines = written(lines, "lines")
    held = lines.select("n", F.explode("features").alias("bucket"))
    crossing = None
    if grams > 1:
        crossing = written(keyed.select("doc_id", "mark", _crossing(grams, buckets).alias("features")), "crossing")
        held = held.unionByName(crossing.select(F.lit(1).cast("long").alias("n"), F.explode("features").alias("bucket")))
    gains = _gains(_totals(held), _totals(_of_target(target, grams, buckets)), buckets)

    def weight(features):
        return F.aggregate(features, F.lit(0).cast("long"), lambda sums, x: sums + F.get(gains, x))

    weighed = lines.select("id", "second", "n_words", F.size("features").alias("n_features"), weight("features").alias("weight"))
    parts = placed.join(weighed, ["id", "second"], "left").select("doc_id", "mark", "n_words", "n_features", "weight")
    if crossing is not None:
        parts = parts.unionByName(crossing.select(
            "doc_id", "mark", F.lit(0).alias("n_words"), F.size("features").alias("n_features"), weight("features").alias("weight")))
    sums = parts.groupBy("doc_id", "mark").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_words", "n_features", "weight")])
    rows = docs.select("doc_id", F.xxhash64(F.col("doc_id").isNull(), "text").alias("mark"))
    rows = rows.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("rows"))
    same = sums["doc_id"].eqNullSafe(rows["doc_id"]) & (sums["mark"] == rows["mark"])
    # equal rows were summed together
    each = [F.expr(f"{c} div rows").alias(c) for c in ("n_words", "n_features", "weight")]
    sums = sums.join(rows, same).select(sums["doc_id"], sums["mark"], *each, F.sequence(F.lit(1), F.col("rows")).alias("rows"))
    sums = sums.select("doc_id", "mark", "n_words", "n_features", "weight", F.explode("rows").alias("copy")).drop("copy")
    return _ranked(sums.withColumn("score", F.col("weight") + _noise(seed)), percent, least)


def _lines(text):
    """The lines of a text that have words, as their words joined by spaces."""
    low = F.translate(F.coalesce(text if isinstance(text, F.Column) else F.col(text), F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.transform(F.split(F.regexp_replace(low, _BREAKS, " "), "\n"), lambda line: F.trim(line)), "")


def _names():
    return F.xxhash64("line").alias("id"), F.xxhash64(F.lit(1), "line").alias("second")


def _bucket(run, buckets):
    return F.pmod(F.crc32(run), F.lit(buckets)).cast("int")


def _features(words, grams, buckets):
    """Buckets of all runs of words within one line. Runs grow by a word at a time, so a long line costs its length."""
    runs, found = words, [_buckets(words, buckets)]
    for k in builtins.range(2, grams + 1):
        left = F.greatest(F.lit(0), F.size(words) - k + 1)
        runs = F.zip_with(F.slice(runs, F.lit(1), left), F.slice(words, F.lit(k), left), lambda run, word: F.concat_ws(" ", run, word))
        found.append(_buckets(runs, buckets))
    return F.concat(*found)


def _buckets(runs, buckets):
    return F.transform(runs, lambda run: _bucket(run, buckets))


def _crossing(grams, buckets):
    """Buckets of all runs of words that begin in one line and end in another."""
    def placed(line, i):
        return F.transform(F.split(line, " "), lambda w: F.struct(w.alias("run"), i.alias("first"), i.alias("last")))

    def longer(run, word):
        return F.struct(F.concat_ws(" ", run["run"], word["run"]).alias("run"), run["first"].alias("first"), word["last"].alias("last"))

    words = F.flatten(F.transform("lines", placed))
    runs, found = words, []
    for k in builtins.range(2, grams + 1):
        left = F.greatest(F.lit(0), F.size(words) - k + 1)
        runs = F.zip_with(F.slice(runs, F.lit(1), left), F.slice(words, F.lit(k), left), longer)
        over = F.filter(runs, lambda run: run["first"] != run["last"])
        found.append(F.transform(over, lambda run: _bucket(run["run"], buckets)))
    return F.concat(*found)


def _of_target(target, grams, buckets):
    texts = target.select(_lines("text").alias("lines"))
    words = F.split("line", " ")
    held = texts.select(F.explode("lines").alias("line")).select(_features(words, grams, buckets).alias("features"))
    if grams > 1:
        held = held.unionByName(texts.select(_crossing(grams, buckets).alias("features")))
    return held.select(F.lit(1).cast("long").alias("n"), F.explode("features").alias("bucket"))


def _totals(held):
    return held.groupBy("bucket").agg(F.sum("n").alias("n"))


def _gains(ours, theirs, buckets):
    """A constant array: the gain of each bucket."""
    have = {r["bucket"]: r["n"] for r in ours.collect()}  # a row for each bucket at most, as of theirs
    want = {r["bucket"]: r["n"] for r in theirs.collect()}
    spark = ours.sparkSession
    rows = [(b, have.get(b, 0), want.get(b, 0)) for b in builtins.range(buckets)]
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    all_s, all_t = [float(sum(x.values()) + buckets) for x in (have, want)]
    gain = F.floor(F.lit(1000) * F.ln((t + 1) * all_s / ((s + 1) * all_t))).cast("long")
    found = spark.createDataFrame(rows, "bucket int, s long, t long").select("bucket", gain.alias("gain")).collect()
    gains = [str(r["gain"]) for r in sorted(found)]
    return F.split(F.lit(",".join(gains)), ",").cast("array<bigint>")  # folded once, not for each row


def _noise(seed):
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def _ranked(rows, percent, least):
    """Ranks over all tasks: rows are dealt out by ranges of the order, and each range begins after the ones before."""
    order = [F.desc("fits"), F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("mark")]
    rows = rows.withColumn("fits", F.col("n_words") >= least)
    rows = written(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "scored")
    sizes = rows.where("fits").groupBy("range").count()
    starts = sizes.select("range", (F.sum("count").over(Window.orderBy("range")) - F.col("count")).alias("before"))
    many = rows.where("fits").count() * percent // 100
    rank = F.row_number().over(Window.partitionBy("range").orderBy(*order)).cast("long") + F.col("before")
    # a row for each range, so never more than there are shuffle partitions
    rows = rows.join(F.broadcast(starts), "range", "left").withColumn("rank", rank)
    drawn = F.when(F.col("fits") & (F.col("rank") <= many), F.col("rank"))
    return rows.select("doc_id", "n_features", "weight", "score", drawn.alias("rank"))


def op13_importance_sample(spark, sf_dir):
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS = (f"list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),"
          " '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')")
_HEX = "list_transform(range(1, octet_length(encode(word)) + 1), lambda i: ('0x' || substr(hex(encode(word)), (2 * i - 1)::int, 2))::bigint)"
_STEP = "case when a % 2 = 1 then xor(a >> 1, 3988292384) else a >> 1 end"
SQL = f"""
with recursive steps(i, k, a) as (
  select range, 0, range from range(256) union all select i, k + 1, {_STEP} from steps where k < 8),
crc as (select list(a order by i) as x from steps where k = 8),
d as (select doc_id, {_WORDS} as w from documents),
b as (select {_WORDS} as w from benchmark),
dw as (select doc_id, unnest(w) as word from d),
bw as (select unnest(w) as word from b),
words as (select word, {_HEX} as bytes from (select word from dw union select word from bw)),
hashed as (
  select word, xor(list_reduce(list_prepend(4294967295::bigint, bytes), lambda c, y: xor(c >> 8, x[xor(c & 255, y) + 1])), 4294967295) % {BUCKETS} as bucket
  from words, crc),
s as (select bucket, count(*) as n from dw join hashed using (word) group by bucket),
t as (select bucket, count(*) as n from bw join hashed using (word) group by bucket),
gains as (
  select range as bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * ((select count(*) from dw) + {BUCKETS})
    / ((coalesce(s.n, 0) + 1)::double * ((select count(*) from bw) + {BUCKETS}))))::bigint as gain
  from range({BUCKETS}) left join s on s.bucket = range left join t on t.bucket = range),
v as (select doc_id, sum(gain) as weight from dw join hashed using (word) join gains using (bucket) group by doc_id),
e as (
  select d.doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from d left join v using (doc_id)),
r as (select doc_id, row_number() over (order by score desc, doc_id) as rank from e where n_features >= {LEAST_WORDS})
select e.*, case when rank <= (select count(*) from r) * {PERCENT} // 100 then rank end as rank
from e left join r using (doc_id)
"""
