"""License scans: word k-gram hashes vote for diagonals of known notices, and merged spans are verified."""

from pyspark.sql import functions as F

from harrow.llm.store import documents, maybe_broadcast, written

GRAM = 3
GAP = 3  # words that may be put in or left out between two matching parts of a notice
CANDIDATE, VERIFIED = 0.5, 0.8  # shares of a notice: k-grams that vote, words that are proven
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases of the base labels, and notices as their licenses word them.
PHRASES = (("mit", ("mit", "license")), ("apache", ("apache", "license")), ("gpl", ("general", "public", "license")))
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
            " documentation files the software to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
            " public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
            " the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
)
# End of fixed values.


def scan(docs, notices=NOTICES, gram=GRAM, gap=GAP):
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) for each row of docs.

    Words are runs of letters, digits and non-ASCII characters, A-Z lowered.
    Base places are those where a phrase's words stand in a row; n_base counts
    them, first_word and last_word are their smallest and largest starts. A
    notice is found where the k-grams of one diagonal, or of diagonals within
    gap of each other, cover half of its k-grams; spans (label, first word,
    share of the notice's words proven equal) list these. labels joins the base
    labels with those of spans of VERIFIED or more; score is the largest share
    (0 for none). A null, empty or wordless text has zero words, no place, empty
    labels and score 0. Rows equal in doc_id and text get the same result; a
    null doc_id is an id like others. Only doc_id and text are read.

    Notices are a parameter of bounded size, so their k-grams are broadcast.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text").alias("mark"))
    # lower() differs from A-Z alone outside ASCII, where it turns one code point, the Kelvin sign, into a letter
    low = F.lower(F.replace(F.coalesce("text", F.lit("")), F.lit("\u212a"), F.lit("\u00ff")))
    docs = docs.select("doc_id", "text", "mark", F.array_remove(F.split(low, _BREAK), "").alias("w"))
    known = [(i, label, text.split()) for i, (label, text) in enumerate(notices)]
    known = spark.createDataFrame(known, "notice int, label string, t array<string>")
    spans = written(_spans(docs, known, gram, gap), "spans")
    spans = maybe_broadcast(spans, 200_000)
    rows = docs.join(spans, "mark", "left")
    return _results(rows, gram)


def _grams(words, gram):
    at = F.sequence(F.lit(0), F.size(words) - gram)
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(gram)]))
    return F.when(F.size(words) >= gram, hashes)


def _spans(docs, known, gram, gap):
    """(mark, found): the candidate spans of each text with any, as arrays of matching places."""
    grams = known.select("notice", "label", "t", F.posexplode(_grams(F.col("t"), gram)).alias("place", "hash"))
    grams = grams.select("notice", "place", "hash")
    hits = docs.select("mark", F.posexplode(_grams(F.col("w"), gram)).alias("pos", "hash"))
    hits = hits.join(F.broadcast(grams), "hash").select("mark", "notice", "pos", "place").distinct()
    diagonal = F.col("pos") - F.col("place")
    votes = hits.groupBy("mark", "notice", diagonal.alias("diagonal")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "place"))).alias("hits"))
    # one text's diagonals of one notice in a row
    runs = votes.groupBy("mark", "notice").agg(F.sort_array(F.collect_list(F.struct("diagonal", "hits"))).alias("d"))
    start = F.transform("d", lambda x, i: (i == 0) | (x["diagonal"] - F.get("d", i - 1)["diagonal"] > gap))
    runs = runs.select("mark", "notice", "d", F.array_compact(F.transform(
        start, lambda x, i: F.when(x, i))).alias("heads"))
    runs = runs.select("mark", "notice", F.posexplode(F.transform("heads", lambda h, i: F.flatten(F.transform(
        F.slice("d", h + 1, F.coalesce(F.get("heads", i + 1), F.size("d")) - h), lambda x: x["hits"])))).alias("k", "hits"))
    runs = runs.join(F.broadcast(known), "notice")
    enough = F.size(F.array_distinct(F.transform("hits", lambda h: h["place"]))) >= F.lit(CANDIDATE) * (F.size("t") - gram + 1)
    return runs.where(enough).groupBy("mark").agg(F.collect_list(F.struct("notice", "label", "t", "hits")).alias("found"))


def _results(rows, gram):
    def proven(span):
        same = F.filter(span["hits"], lambda h: F.slice(F.col("w"), h["pos"] + 1, gram) == F.slice(span["t"], h["place"] + 1, gram))
        words = F.flatten(F.transform(same, lambda h: F.sequence(h["place"], h["place"] + gram - 1)))
        return F.size(F.array_distinct(words)) / F.size(span["t"])

    spans = F.transform("found", lambda s: F.struct(
        s["label"].alias("label"), F.array_min(F.transform(s["hits"], lambda h: h["pos"])).cast("long").alias("first_word"),
        proven(s).alias("share")))
    # every base phrase ends in the same word: texts without it are not walked
    ends = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", i) == "license")
    ends = F.when((F.size("w") > 0) & F.array_contains("w", "license"), ends)

    def starts(words):
        n = len(words)
        fits = F.filter("ends", lambda e: F.forall(
            F.array(*[F.coalesce(F.get("w", e - n + 1 + j) == x, F.lit(False)) & (e >= n - 1) for j, x in enumerate(words)]),
            lambda x: x))
        return F.coalesce(F.transform(fits, lambda e: e - n + 1), F.array().cast("array<int>"))

    rows = rows.select("doc_id", "w", ends.alias("ends"), F.coalesce(
        spans, F.array().cast("array<struct<label:string,first_word:bigint,share:double>>")).alias("spans"))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), "spans", *[
        starts(words).alias(f"at_{label}") for label, words in PHRASES])
    places = F.concat(*[F.col(f"at_{label}") for label, _ in PHRASES])
    base = F.array_compact(F.array(*[F.when(F.size(f"at_{label}") > 0, F.lit(label)) for label, _ in PHRASES]))
    rows = rows.select("doc_id", "n_words", "spans", places.alias("places"), F.array_sort(base).alias("base"))
    found = F.transform(F.filter("spans", lambda s: s["share"] >= VERIFIED), lambda s: s["label"])
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", found)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"), "spans")


def op5_license_scan(spark, sf_dir):
    return scan(documents(spark, sf_dir)).drop("spans")


_VALUES = ", ".join(f"({i}, '{label}', string_split('{text}', ' '))" for i, (label, text) in enumerate(NOTICES))
SQL = f"""
with k(notice, label, t) as (values {_VALUES}),
kg as (select notice, unnest(range(1, len(t) - 1)) as place, t from k),
kh as (select notice, place, array_to_string(t[place:place + 2], ' ') as g from kg),
d as (select doc_id, list_filter(string_split_regex(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w from documents),
dg as (select doc_id, unnest(range(1, len(w) - 1)) as pos, w from d where len(w) >= 3),
h as (select doc_id, notice, pos, place, pos - place as diagonal
  from dg join kh on array_to_string(w[pos:pos + 2], ' ') = g),
m as (select *, diagonal - lag(diagonal) over (partition by doc_id, notice order by diagonal) > {GAP} as fresh from h),
r as (select *, sum(coalesce(fresh::int, 0)) over (partition by doc_id, notice order by diagonal
  range between unbounded preceding and current row) as run from m),
c as (select doc_id, notice, run from r join k using (notice) group by doc_id, notice, run, len(t)
  having count(distinct place) >= {CANDIDATE} * (len(t) - 2)),
s as (select doc_id, label, count(distinct place + j) / len(t) as share
  from r join c using (doc_id, notice, run) join k using (notice), range(3) o(j) group by doc_id, notice, run, label, len(t)),
p as (
  select doc_id, 'mit' as label, pos from (select doc_id, unnest(range(1, len(w))) as pos, w from d) where w[pos] = 'mit' and w[pos + 1] = 'license'
  union all
  select doc_id, 'apache', pos from (select doc_id, unnest(range(1, len(w))) as pos, w from d) where w[pos] = 'apache' and w[pos + 1] = 'license'
  union all
  select doc_id, 'gpl', pos from (select doc_id, unnest(range(1, len(w) - 1)) as pos, w from d)
    where w[pos] = 'general' and w[pos + 1] = 'public' and w[pos + 2] = 'license'),
b as (select doc_id, count(*) as n_base, min(pos) - 1 as first_word, max(pos) - 1 as last_word,
  string_agg(distinct label, ',' order by label) as base_labels from p group by doc_id),
l as (select doc_id, string_agg(distinct label, ',' order by label) as labels from (
  select doc_id, label from p union all select doc_id, label from s where share >= {VERIFIED}) group by doc_id),
z as (select doc_id, max(share) as score from s group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from d left join b using (doc_id) left join l using (doc_id) left join z using (doc_id)
"""
