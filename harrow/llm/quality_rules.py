"""Quality rules: base counts of each text, and limits on its repeated passages found by suffix array."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from harrow.llm import quality_tasks as tasks
from harrow.llm.store import documents, small_batches

LEAST = 10  # words of a repeat that counts
MAX_COVERED = 30  # percent of the words that such repeats may cover
MAX_LONGEST = 100  # words of the longest repeat


def rate(docs, least=LEAST, max_covered=MAX_COVERED, max_longest=MAX_LONGEST, report="quality"):
    """docs with a struct column report: the counts, base_failed and kept.

    Words stand between ASCII white space. n_covered is the number of words in
    maximal repeats (of least words or more, overlaps included) of the text
    within itself, longest_repeat the words of its longest one. kept is false
    where base_failed is, where repeats cover more than max_covered percent, or
    where one is longer than max_longest. A null, empty or blank text has zero
    counts and fails by its length. Every row gets its own result, whatever its
    doc_id. Other columns pass through, but one named like the report is
    replaced.
    """
    run = tasks.measurer(least)

    def measured(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return run(texts)

    kind = ", ".join(f"{c} long" for c in tasks.COLUMNS)
    # not to be moved or computed twice by the planner, as a filter on the result would have it
    count = F.pandas_udf(measured, kind).asNondeterministic()
    rows = docs.withColumn(report, count("text"))
    q = F.col(report)
    failed = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
    good = ~failed & (100 * q["n_covered"] <= max_covered * q["n_words"]) & (q["longest_repeat"] <= max_longest)
    return rows.withColumn(report, q.withField("base_failed", failed).withField("kept", good))


def op7_quality_rules(spark, sf_dir):
    small_batches(spark)
    return rate(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "quality.*").drop("longest_repeat")


SQL = """
with d as (
  select doc_id, text, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
c as (
  select doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
      - len(list_distinct(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) as n_dup_lines
  from d),
g as (select unnest([3, 10, 101]) as k),
s as (select doc_id, k, unnest(range(1, len(w) - k + 2)) as i, w from d, g where len(w) >= k),
h as (select doc_id, k, i, count(*) over (partition by doc_id, k, md5(array_to_string(w[i:i + k - 1], ' '))) as n from s),
p as (select doc_id, k, count(distinct i + j) as covered from h, range(101) t(j) where n > 1 and j < k and k < 101 group by 1, 2),
m as (select doc_id, max(k) filter (n > 1) as most from h group by doc_id),
b as (
  select c.*, coalesce(x.covered, 0) as n_repeat_words, coalesce(y.covered, 0) as n_covered, coalesce(most, 0) > 100 as too_long
  from c left join p x on x.doc_id = c.doc_id and x.k = 3 left join p y on y.doc_id = c.doc_id and y.k = 10
    left join m on m.doc_id = c.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * n_covered <= 30 * n_words and not too_long as kept
from b
"""
