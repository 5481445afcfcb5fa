"""Source divergence audit: equal texts are counted once with their sources, and sources compared by sparse term counts."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from harrow.llm import audit_tasks as tasks
from harrow.llm.store import documents, maybe_broadcast, small_batches, written

LEAST_DOCS = 30  # documents of a language that hold a term which is kept
TOP_TERMS = 50  # ranks of the terms of a source that are reported
_TERMS, _SOURCES = 4096, 256  # what one block compares: terms, and sources of each side
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def audit(docs, least=LEAST_DOCS, top=TOP_TERMS, terms=_TERMS, sources=_SOURCES):
    """(lang, source, part, item, value, rank): how the sources of each language differ in their words.

    Only lang, source and text are read; null reads as ''. Terms are runs of
    letters and non-ASCII characters with A-Z lowered; a language keeps those in
    at least `least` of its documents. Each source of a language, and the
    language itself, gives a kept term p parts of 10^9, smoothed by 5. Part
    'pair' ranks all other sources of the language by the sum of the differences
    of p; part 'term' ranks the kept terms that a source uses more than its
    language does, down to rank `top`. Equal values rank by item, in bytes. A
    source without terms has pairs and no term; a language with one source has
    no pair. Repeated rows count as often as they stand; an empty table gives no
    row.

    Equal texts of a language are tokenized once and weighed by how often each
    source holds them. A text that stands once is read in place; only repeated
    ones, once for each task, are shuffled. Counts are added up in the task
    before they are shuffled. Sources meet in blocks of some terms and some
    sources, which hold the terms that occur there and no zeros.
    """
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    tally = written(_tally(rows), "tally")
    every = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_docs"))
    kept = tally.where("term is not null").groupBy("lang", "term")
    kept = kept.agg(F.sum("docs").alias("docs"), F.sum("n").alias("all")).where(F.col("docs") >= least)
    kept = written(kept.select("lang", "term", "all"), "kept")
    postings = written(tally.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all"), "postings")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all").alias("lang_n"))
    sizes = postings.groupBy("lang", "source").agg(F.sum("n").alias("source_n"))
    groups = every.select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["source_n", "terms", "lang_n"])
    groups = written(groups.withColumn("zero", _parts(F.lit(0), "source_n")), "groups")
    small = maybe_broadcast(groups, 200_000)
    postings = postings.join(small, ["lang", "source"]).select(
        "lang", "source", "term", _parts(F.col("n"), "source_n").alias("p"), _parts(F.col("all"), "lang_n").alias("q"))
    return _pairs(groups, postings, terms, sources).unionByName(_terms(postings, top))


def _tally(rows):
    """(lang, source, term, n, docs): occurrences, and documents that hold the term, of each source."""
    key = ["lang", "mark", "second"]
    marked = rows.select("*", F.xxhash64("text").alias("mark"), F.xxhash64(F.lit(1), "text").alias("second"))
    held = written(marked.groupBy(*key, "source").agg(F.count(F.lit(1)).alias("n")), "held")
    often = held.groupBy(*key).agg(F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("sources"))
    often = written(often.where("n > 1").select(*key, "sources"), "often")
    repeated = maybe_broadcast(often.select(*key), 1_000_000)
    once = marked.join(repeated, key, "left_anti").select(
        "lang", "text", F.array(F.struct("source", F.lit(1).cast("long").alias("n"))).alias("sources"))
    texts = marked.join(repeated, key, "left_semi").select(*key, "text").distinct()
    copied = texts.join(often, key).select("lang", "text", "sources")
    kind = "lang string, source string, term string, n long, docs long"
    counted = once.unionByName(copied).mapInArrow(tasks.counter, kind)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _parts(n, total):
    """Parts of 10^9, exact at any size."""
    above = F.lit(1_000_000_000).cast("decimal(10,0)") * (n + 5).cast("decimal(20,0)")
    below = (F.col(total) + 5 * F.col("terms")).cast("decimal(20,0)")
    # a language that keeps no term has no p; the divisor is then replaced, and nothing is summed over terms
    return F.call_function("div", above, F.greatest(below, F.lit(1).cast("decimal(20,0)"))) + 1


def _pairs(groups, postings, terms, sources):
    counts = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"), F.first("terms").alias("terms"))
    dealt = counts.select("lang", F.ceil(F.col("n_sources") / sources).cast("int").alias("tiles"),
                          F.greatest(F.lit(1), F.ceil(F.col("terms") / terms)).cast("int").alias("blocks"))
    dealt = F.broadcast(dealt) if dealt.count() <= 100_000 else dealt
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    empty = F.lit(None)
    heads = groups.join(dealt, "lang").select(
        "lang", "source", tile.alias("tile"), "tiles", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        empty.cast("string").alias("term"), F.col("zero").alias("p"), "terms")
    cells = postings.join(dealt, "lang").select(
        "lang", "source", tile.alias("tile"), "tiles", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"),
        "term", "p", empty.cast("long").alias("terms"))
    both = heads.unionByName(cells)
    both = both.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    both = both.select("lang", "block", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"),
                       "source", "tile", "term", "p", "terms")
    sums = both.groupBy("lang", "block", "one", "two").applyInPandas(tasks.differences, "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(sums, "pair")


def _terms(postings, top):
    more = postings.where(F.col("p") > F.col("q"))
    more = more.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(more, "term").where(F.col("rank") <= top)


def _ranked(values, part):
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return values.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def op11_source_audit(spark, sf_dir):
    small_batches(spark)
    return audit(documents(spark, sf_dir))


SQL = f"""
with d as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from documents),
g as (select distinct coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
k as (select lang, term, count(*) as q_n from d group by lang, term having count(distinct id) >= {LEAST_DOCS}),
v as (select lang, count(*) as v, sum(q_n) as lang_n from k group by lang),
c as (select lang, source, term, count(*) as n from d semi join k using (lang, term) group by all),
t as (select lang, source, sum(n) as source_n from c group by all),
p as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + 1000000000::hugeint * (coalesce(c.n, 0) + 5) // (coalesce(source_n, 0) + 5 * v) as p,
    1 + 1000000000::hugeint * (q_n + 5) // (lang_n + 5 * v) as q
  from g join k on k.lang = g.lang join v on v.lang = g.lang left join t on t.lang = g.lang and t.source = g.source
    left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pair as (
  select a.lang, a.source, 'pair' as part, b.source as item,
    coalesce((select sum(abs(x.p - y.p)) from p x join p y on x.lang = y.lang and x.term = y.term
      where x.lang = a.lang and x.source = a.source and y.source = b.source), 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source),
u as (
  select * from pair union all
  select lang, source, 'term', term, (p - q)::bigint from p where n > 0 and p > q),
r as (
  select *, row_number() over (partition by lang, source, part order by value desc, encode(item))::int as rank from u)
select * from r where part = 'pair' or rank <= {TOP_TERMS}
"""
