"""Line dedup: segment-partition edit join over all distinct lines, first occurrence kept."""

from pyspark.sql import functions as F

from harrow.llm import line_tasks as tasks
from harrow.llm import union_find
from harrow.llm.graph import components
from harrow.llm.store import documents, maybe_broadcast, written

MIN_CHARS = 20  # shorter lines are left alone
LIMIT = ((MIN_CHARS, 1), *((25 * k, k) for k in range(2, 9)))  # (least length, edits)
BLOCK = 500_000  # characters that one block holds at most, but for a longer line


def dedup_lines(docs, limit=LIMIT, min_chars=MIN_CHARS, block=BLOCK, report="line_report", equal_chars=None):
    """docs with the text less its repeated lines, and a struct column report (n_lines, n_removed), longs.

    Lines end at \\n; blanks, tabs and carriage returns around one do not count.
    Lines of min_chars characters or more link if their edit distance is at most
    the limit of the shorter one: limit is one number for all lines, or steps
    (least length, edits), both rising, of which the first are for lines of
    fewer characters, too. Of all lines connected by links, equal ones included, the first stays
    (smallest doc_id, then place in the text; null doc_ids last) and all others
    go, within and across documents. Shorter lines of equal_chars characters or
    more link if they are equal; without it they stay. A null text stays null,
    with no lines; a text without a repeat stays as it is. Rows equal in doc_id
    and text are one document and get the same result. Other columns pass
    through, but one named like the report is replaced.

    Lines of a link share one of limit + 1 segments at nearly the same place
    (tasks.signatures, from both ends of each line); lines that share one are
    compared in blocks of bounded size. Equal lines count once in all of this.
    Jobs run while the frame is built.
    """
    steps = ((0, limit),) if isinstance(limit, int) else limit
    minimum = max(min_chars, steps[0][1] + 1)
    classes = tasks.length_classes([(max(minimum, least), k) for x, (least, k) in enumerate(steps)
                                    if x + 1 == len(steps) or steps[x + 1][0] > minimum])
    size = tasks.reach(classes)
    least = minimum if equal_chars is None else max(1, min(equal_chars, minimum))
    source = docs.drop(report)
    spans = source.select("text", *_key())
    lines = spans.select("doc", "mark", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    # trimming the end of a text visits all of its characters
    blanks, ends = F.lit(" \t\r"), F.endswith("raw", F.lit(" ")) | F.endswith("raw", F.lit("\t")) | F.endswith("raw", F.lit("\r"))
    line = F.when(ends, F.btrim("raw", blanks)).otherwise(F.ltrim("raw", blanks))
    lines = lines.select("doc", "mark", "pos", line.alias("line"))
    lines = lines.select("*", F.char_length("line").alias("n")).where(F.col("n") >= least)
    # every line by its hashes and signatures, without its text: texts are split here and once more for what may be linked
    short = F.when(F.col("n") <= 2 * size, F.col("line")).otherwise(
        F.concat(F.left("line", F.lit(size)), F.right("line", F.lit(size))))
    signed = lines.select("doc", "mark", "pos", "n", *_names(), F.when(F.col("n") >= minimum, short).alias("line"))
    signed = signed.mapInArrow(tasks.signer(classes), "doc long, mark long, pos int, n int, id long, second long, signs array<long>")
    signed = written(signed, "lines")
    placed, signs = signed.drop("signs"), signed.select("id", "signs")
    distinct = placed.groupBy("id", "second").agg(F.count(F.lit(1)).alias("times"), F.max("n").alias("n"))
    distinct = written(distinct, "distinct")
    members = distinct.select("id", F.col("n").cast("long").alias("weight")).groupBy("id").agg(F.max("weight").alias("weight"))
    close = written(_blocks(members, signs.select("id", F.explode("signs").alias("bucket")), block), "blocks")
    wanted = written(close.select("id").distinct(), "wanted")
    texts = lines.select(_names()[0], "line").join(maybe_broadcast(wanted, 1_000_000), "id", "left_semi").distinct()
    sought = close.join(written(texts, "texts"), "id").select("block", "id", "line")
    sought = sought.repartition("block").sortWithinPartitions("block", "id", "line")
    linked = sought.mapInPandas(tasks.linker(classes), "a long, b long")
    # each task joins what it can of its own links, so that long paths are short by then
    groups = components(linked.mapInArrow(union_find.joiner(), "a long, b long"))
    repeated = distinct.join(groups, F.col("id") == F.col("node"), "left").where("times > 1 or component is not null")
    repeated = written(repeated.select("id", "second", F.coalesce("component", "id").alias("class")), "repeated")
    found = placed.select("doc", "mark", "pos", "id", "second").join(repeated, ["id", "second"])
    found = written(found.select("doc", "mark", "pos", "class"), "found")
    at = F.struct("doc", "mark", "pos")
    firsts = written(found.groupBy("class").agg(F.min(at).alias("first")), "firsts")
    gone = found.join(firsts, "class").where(at != F.col("first"))
    gone = gone.groupBy("doc", "mark").agg(F.collect_set("pos").alias("gone"))
    return _without(source, gone, report)


def _key():
    """A document's key: its id (null: the largest) and a hash of its text."""
    return (F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"),
            F.xxhash64(F.col("doc_id").isNull(), "text").alias("mark"))


def _names():
    """Two hashes that name a line; the first alone names it where candidates are sought."""
    return F.xxhash64("line").alias("id"), F.xxhash64(F.lit(1), "line").alias("second")


def _blocks(members, buckets, limit):
    """(block, id): groups of at most about `limit` weight in which all links are to be sought.

    members: id, weight; buckets: bucket, id. A bucket has its smallest id as hub, and that hub the smallest hub that it
    is with itself. All buckets that end at one hub are a block: so every two ids of a bucket meet, and as copies of one
    text share most hubs, an id is sent few times, however many buckets it has. The ids of a block over the limit are
    dealt into chunks, and each two chunks meet.
    """
    hubs = buckets.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("top"))
    hubs = written(hubs.where(F.col("hub") != F.col("top")).select("bucket", "hub"), "hubs")
    pairs = written(buckets.join(maybe_broadcast(hubs, 1_000_000), "bucket").select("hub", "id").distinct(), "pairs")
    first = pairs.groupBy("id").agg(F.min("hub").alias("first")).withColumnRenamed("id", "hub")
    pairs = pairs.join(first, "hub").select(F.col("first").alias("hub"), "id").distinct()
    pairs = written(pairs.join(members, "id"), "members")
    sizes = pairs.groupBy("hub").agg(F.ceil(F.sum("weight") / limit).cast("int").alias("chunks"))
    large = maybe_broadcast(written(sizes.where("chunks > 1"), "large"), 1_000_000)
    whole = pairs.join(large, "hub", "left_anti").select(F.col("hub").cast("string").alias("block"), "id")
    dealt = pairs.select("hub", "id").join(large, "hub")
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    pair = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = dealt.select("hub", "id", own.alias("c"), pair.alias("d"))
    name = F.concat_ws("|", "hub", F.least("c", "d"), F.greatest("c", "d"))
    return whole.unionByName(dealt.select(name.alias("block"), "id"))


def _without(source, gone, report):
    """The documents joined with the places of their repeated lines."""
    body = F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("body")
    doc, mark = _key()
    rows = source.select(body, doc, mark).join(gone, ["doc", "mark"], "left")
    rows = rows.withColumn("lines", F.split("body.text", "\n"))
    # array_except works by hash, so a text of very many lines stays linear
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    text = F.when(F.col("gone").isNull(), F.col("body.text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    counts = F.struct(F.greatest(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
                      F.greatest(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))
    columns = [text.alias("text") if c == "text" else F.col(f"body.`{c}`").alias(c) for c in source.columns]
    return rows.select(*columns, counts.alias(report))


def op1_line_dedup(spark, sf_dir):
    done = dedup_lines(documents(spark, sf_dir))
    return done.select("doc_id", "line_report.*", F.char_length("text").cast("long").alias("n_chars_left"),
                       F.md5("text").alias("text_md5"))


SQL = """
with recursive l as (
  select doc_id, unnest(string_split(text, chr(10))) as raw, unnest(range(len(string_split(text, chr(10))))) as pos from documents),
t as (select doc_id, pos, raw, trim(raw, ' ' || chr(9) || chr(13)) as line from l),
d as (select distinct line, length(line) as n, greatest(1, least(8, length(line) // 25)) as k from t where length(line) >= 20),
-- limits a line takes part in: its own, and the one below if a shorter line may have it
p as (select line, n, k as own, k from d union all select line, n, k, k - 1 from d where k > 1 and n - k + 1 < 25 * k),
q as (select *, greatest(20, 25 * k) // (k + 1) as w from p),
g as (select *, i < k // 2 + 1 as ahead, unnest(range(-(case when i < k // 2 + 1 then i else k - i end),
    1 + case when i < k // 2 + 1 then i else k - i end)) as shift from (select *, unnest(range(k + 1)) as i from q)),
s as (select line, n, own, k, i, shift, case when ahead then substr(line, i * w + 1 + shift, w)
    else substr(line, n - (k - i + 1) * w + 1 + shift, w) end as piece from g),
m as (select distinct a.line as a, b.line as b, a.k from s a join s b using (k, i, piece)
  where a.shift = 0 and a.own = a.k and b.n between a.n and a.n + a.k and a.line <> b.line),
-- levenshtein counts bytes: characters of several bytes become control characters, each pair by its own alphabet
v as (select *, array_to_string(list_distinct(regexp_extract_all(a || b, '[^\\x00-\\x7F]')), '') as wide,
  array_to_string(list_transform(range(1, 32), lambda c: chr(c::int)), '') as plain from m),
h as (select a, b from v where levenshtein(translate(a, wide, plain), translate(b, wide, plain)) <= k),
e as (select a, b from h union select b, a from h),
r(a, b) as (select a, a from e union select r.a, e.b from r join e on e.a = r.b),
c as (select line, coalesce(min(b), line) as class from d left join r on a = line group by line),
o as (select doc_id, pos, row_number() over (partition by class order by doc_id, pos) as k from t join c using (line)),
f as (select t.*, coalesce(k, 1) > 1 as gone from t left join o using (doc_id, pos)),
u as (select doc_id, count(*) as n_lines, sum(gone::int)::bigint as n_removed,
  coalesce(string_agg(raw, chr(10) order by pos) filter (not gone), '') as text from f group by doc_id)
select doc_id, n_lines, n_removed, length(text) as n_chars_left, md5(text) as text_md5 from u
"""
