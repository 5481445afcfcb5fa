"""Mixing sources to target weights: budgets go down a tree of groups, shortages to siblings first."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Window
from pyspark.sql import functions as F

from harrow.llm.store import documents, maybe_broadcast, written

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"
EPOCHS = 2
SHARE = (4, 5)  # the budget as a share of all tokens
ROWS = 4096  # rows of a leaf that one slice of its order aims at
# Weights by level; a value that is not named has weight 1.
WEIGHTS = ({"d0": 3, "d1": 2}, {"en": 4, "de": 2, "fr": 2, "es": 2}, {})


def domain_of(source):
    """Stand-in for a table of domains: four groups of sources by the last letter of the name."""
    return F.concat(F.lit("d"), (F.ascii(F.right(source, F.lit(1))) % 4).cast("string"))


def mix(docs, levels: Sequence, weights: Sequence[Mapping[str, int]] = WEIGHTS, share=SHARE, epochs=EPOCHS, seed=SEED,
        rows=ROWS, report="mix"):
    """The rows of docs that make up the mix, once for each epoch that takes them, with a struct column report.

    levels are columns from the root of the tree down to the leaves (domain,
    language, source); weights has whole positive numbers for each level. A
    row's tokens are its words between ASCII white space. The budget is share of
    all tokens. A node gets its part of its parent's budget by weight, but no
    more than its capacity, epochs times its tokens. What it cannot take goes to
    its siblings by their weights; a budget never exceeds the capacity below it,
    so the parent's siblings have had only what all siblings together cannot
    take. Parts are rounded down. Each leaf takes whole epochs while they fit,
    then, in an order seeded for that epoch, the longest run of rows from the
    start whose tokens fit.

    A null level is a group of its own, named ''. Rows equal in doc_id and text
    are taken together. A null text has no tokens; rows without tokens are taken
    with the rows around them. report holds leaf (names joined by /), tokens and
    epoch (from 1). An empty table gives an empty mix. Other columns pass
    through, but one named like the report is replaced.

    Tokens are summed by leaf and slice of the order before anything is sorted;
    only the one slice of each leaf where its budget ends is sorted, and slices
    keep their size as a leaf grows. Texts are not shuffled.
    """
    names = [f"level_{i}" for i in range(len(levels))]
    source = docs.drop(report)
    body = F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("body")
    rows_in = source.select(
        body, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.md5(F.coalesce("text", F.lit(""))).alias("tie"),
        *[F.coalesce(c, F.lit("")).alias(n) for c, n in zip(levels, names, strict=True)])
    slim = written(rows_in.drop("body"), "tokens")
    leaves = slim.groupBy(*names).agg(F.sum("tokens").alias("own"), F.count(F.lit(1)).alias("rows"))
    plan = written(_budgets(written(leaves, "leaves"), names, weights, share, epochs), "budgets")
    plan = written(_cuts(slim, plan, names, seed, rows), "cuts")
    taken = rows_in.join(maybe_broadcast(plan, 100_000), names)
    hit = (F.col("epoch") <= epochs) & (F.struct(_order(seed), "tie") <= F.struct("cut", "cut_tie"))
    partly = F.when(hit, F.array("epoch"))
    all_epochs = F.concat(F.expr("sequence(1, epoch)"), F.coalesce(partly, F.array().cast("array<int>")))
    all_epochs = F.filter(all_epochs, lambda e: (e < F.col("epoch")) | hit)
    taken = taken.withColumn("epoch", F.explode(F.array_distinct(all_epochs)))
    result = F.struct(F.concat_ws("/", *names).alias("leaf"), "tokens", "epoch").alias(report)
    return taken.select(*[F.col(f"body.`{c}`").alias(c) for c in source.columns], result)


def _order(seed):
    """Where a row stands in its leaf's order of the epoch that is taken in part."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.col("epoch").cast("string"), "id"))


def _budgets(leaves, names, weights, share, epochs):
    """names, own, rows, epoch, rest: the epoch that each leaf takes in part, and the tokens it may take of it."""
    up, down = share
    parents = leaves.agg(F.floor(F.coalesce(F.sum("own"), F.lit(0)) * up / F.lit(down)).cast("long").alias("budget"))
    for depth, own_weights in enumerate(weights):
        path, above = names[:depth + 1], names[:depth]
        named = F.create_map(*[F.lit(x) for pair in {"": 1, **own_weights}.items() for x in pair])
        level = leaves.groupBy(*path).agg((F.sum("own") * epochs).alias("capacity"))
        level = level.join(parents, above) if above else level.join(parents, F.lit(True))
        level = level.withColumn("weight", F.coalesce(F.try_element_at(named, F.col(path[-1])), F.lit(1)))
        # by capacity for its weight: as long as one cannot take its part, the rest share what it leaves;
        # the part of one weight rises up to the first that can, and falls after it
        siblings = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))
        order = siblings.orderBy(F.col("capacity") / F.col("weight"), path[-1])
        before = F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1))
        onward = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
        level = level.withColumn("part", (F.col("budget") - F.coalesce(before, F.lit(0))) / onward)
        part = F.floor(F.max("part").over(siblings) * F.col("weight")).cast("long")
        parents = level.select(*path, F.least("capacity", part).alias("budget"))
    plan = leaves.join(parents, names)
    whole = F.when(F.col("own") > 0, F.floor(F.col("budget") / F.col("own"))).otherwise(0).cast("int")
    return plan.select(*names, "rows", (whole + 1).alias("epoch"), (F.col("budget") - whole * F.col("own")).alias("rest"))


def _cuts(slim, plan, names, seed, rows):
    """names, epoch, cut, cut_tie: the last place of the order that fits, for each leaf (null if none does)."""
    placed = slim.join(maybe_broadcast(plan, 100_000), names).withColumn("order", _order(seed))
    first = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    slices = F.ceil(F.col("rows") / rows)
    placed = placed.withColumn("slice", F.floor(first * slices / F.lit(1 << 32)).cast("long"))
    sums = placed.groupBy(*names, "slice", "rest").agg(F.sum("tokens").alias("held"))
    upto = Window.partitionBy(*names).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("held").over(upto), F.lit(0)))
    ends = sums.where("before <= rest").groupBy(*names).agg(
        F.max("slice").alias("slice"), F.max("before").alias("before"))
    inside = placed.join(maybe_broadcast(written(ends, "ends"), 100_000), [*names, "slice"])
    run = Window.partitionBy(*names).orderBy("order", "tie").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("sum", F.col("before") + F.sum("tokens").over(run)).where("sum <= rest")
    last = inside.groupBy(*names).agg(F.max(F.struct("order", "tie")).alias("last"))
    # no row of the slice fits: all slices before it do
    start = F.lpad(F.conv(F.ceil(F.col("slice") * F.lit(1 << 32) / F.ceil(F.col("rows") / rows)).cast("string"), 10, 16), 8, "0")
    plan = plan.join(ends, names).join(last, names, "left")
    return plan.select(*names, "epoch", F.coalesce("last.order", F.lower(start)).alias("cut"),
                       F.coalesce("last.tie", F.lit("")).alias("cut_tie"))


def tree_levels():
    return [domain_of(F.coalesce("source", F.lit(""))), F.col("lang"), F.col("source")]


def op6_source_mix(spark, sf_dir):
    mixed = mix(documents(spark, sf_dir), tree_levels())
    return mixed.select("doc_id", "mix.*")


SQL = """
with d as (
  select doc_id, coalesce(doc_id::varchar, '') as id, md5(coalesce(text, '')) as tie,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as tokens,
    'd' || (ascii(right(coalesce(source, ''), 1)) % 4)::varchar as l0, coalesce(lang, '') as l1, coalesce(source, '') as l2 from documents),
v as (select l0, l1, l2, sum(tokens)::bigint as own from d group by all),
t as (select floor(coalesce(sum(own), 0) * 4 / 5)::bigint as budget from v),
a1 as (select l0, (sum(own) * 2)::bigint as c, case l0 when 'd0' then 3 when 'd1' then 2 else 1 end as w, any_value(budget) as b from v, t group by l0),
a2 as (select *, (b - coalesce(sum(c) over (order by c / w, l0 rows between unbounded preceding and 1 preceding), 0))
  / sum(w) over (order by c / w, l0 rows between current row and unbounded following) as p from a1),
a as (select l0, least(c, floor(max(p) over () * w))::bigint as budget from a2),
b1 as (select l0, l1, (sum(own) * 2)::bigint as c, case l1 when 'en' then 4 when 'de' then 2 when 'fr' then 2 when 'es' then 2 else 1 end as w,
  any_value(budget) as b from v join a using (l0) group by l0, l1),
b2 as (select *, (b - coalesce(sum(c) over (partition by l0 order by c / w, l1 rows between unbounded preceding and 1 preceding), 0))
  / sum(w) over (partition by l0 order by c / w, l1 rows between current row and unbounded following) as p from b1),
b as (select l0, l1, least(c, floor(max(p) over (partition by l0) * w))::bigint as budget from b2),
c1 as (select l0, l1, l2, (own * 2)::bigint as c, own, 1 as w, budget as b from v join b using (l0, l1)),
c2 as (select *, (b - coalesce(sum(c) over (partition by l0, l1 order by c / w, l2 rows between unbounded preceding and 1 preceding), 0))
  / sum(w) over (partition by l0, l1 order by c / w, l2 rows between current row and unbounded following) as p from c1),
c3 as (select l0, l1, l2, own, least(c, floor(max(p) over (partition by l0, l1) * w))::bigint as budget from c2),
c as (select *, case when own > 0 then budget // own else 0 end as whole from c3),
o as (select d.*, whole, budget - whole * own as rest, md5('mix|' || (whole + 1)::varchar || '|' || id) as h from d join c using (l0, l1, l2)),
s as (select *, sum(tokens) over (partition by l0, l1, l2 order by h, tie range between unbounded preceding and current row) as upto from o),
e as (select *, unnest(range(1, (whole + 1 + (upto <= rest and whole < 2)::int)::bigint)) as epoch from s)
select doc_id, l0 || '/' || l1 || '/' || l2 as leaf, tokens, epoch::int as epoch from e
"""
