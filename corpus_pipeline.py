"""Documents to training ids: quality rules, line dedup, MinHash near-dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before has kept; all but the last return the columns of documents.
"""

import public_tokenizers
from pyspark.sql import functions as F

from harrow.llm import bpe, line_dedup, minhash_dedup, quality_rules, source_mix
from harrow.llm.store import documents, small_batches, written

NEAR_PERCENT = 80  # similarity of word shingles from which documents are near duplicates


def quality(spark, docs, sf_dir):
    """Documents that pass the base rules and the limits on repeated passages."""
    small_batches(spark)
    rated = quality_rules.rate(docs, report="_quality")
    return rated.where(F.col("_quality.kept")).select(*docs.columns)


def lines(spark, docs, sf_dir):
    """Documents less their repeated lines; one whose lines with words have all gone, goes."""
    done = line_dedup.dedup_lines(docs, report="_lines", equal_chars=1)
    left = (F.col("_lines.n_removed") == 0) | F.regexp_like("text", F.lit(source_mix.WORD))
    done = done.where(left)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.char_length("text").cast(kind))
    return done.select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """One document, the first, of each group of near duplicates."""
    small_batches(spark)
    found = minhash_dedup.near_duplicates(docs, NEAR_PERCENT)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def mix(spark, docs, sf_dir):
    """Documents of the mix; each leaf is taken once at most, so no document comes twice."""
    return source_mix.mix(docs, source_mix.tree_levels(), epochs=1, report="_mix").select(*docs.columns)


def encode(spark, docs, sf_dir):
    """Ids of each text, and whether they decode to its bytes."""
    small_batches(spark)
    both = bpe.round_trip(spark, public_tokenizers.path(bpe.RANKS))("text")
    rows = docs.select("doc_id", "lang", "source", "text", both.alias("done"))
    whole = F.col("done.decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return rows.select("doc_id", "lang", "source", F.size("done.ids").cast("long").alias("n_tokens"), "done.ids",
                       whole.alias("round_trip"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_dedup", near_duplicates),
    ("source_mix", mix),
    ("byte_bpe", encode),
]

#: SQL cannot express the merges of the last stage; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the whole documents table, each written and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
