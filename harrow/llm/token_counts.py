"""Token counts: strings proven to be one token are counted directly, only the rest are merged."""

from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F

from harrow.llm import bpe_tasks as tasks
from harrow.llm.store import documents, small_batches

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512


def single_tokens(merges):
    """Vocabulary strings whose own merges end in one token, proven by running the merges of each."""
    pieces = list(merges.pieces.values())
    whole = [p for p, ids in zip(pieces, merges.encode(pieces), strict=True) if len(ids) == 1]
    texts = (p.decode("utf-8", "replace") for p in whole)
    return {t for t in texts if "�" not in t}


def _merges(data):
    return tasks.from_json(data)[0]


def counter(spark, path, pattern=public_tokenizers.PATTERN):
    """Column function: text -> number of tokens (long) by the vocabulary in path.

    A special string in a text is one token and ends the pre-token before it, as
    is the default of the file's library; none is added. A null or empty text
    has none. The file and the proven strings, both bounded by the vocabulary,
    are broadcast.
    """
    with open(path, "rb") as file:
        data = file.read()
    merges, specials = tasks.from_json(data)
    shared = spark.sparkContext.broadcast((data, single_tokens(merges)))
    specials = sorted(specials, key=len, reverse=True)

    def others(text, single, split):
        """Tokens told at once, and the pre-tokens that are left."""
        parts = [text]
        for s in specials:
            parts = [x for p in parts for x in p.split(s)]
        n, rest = len(parts) - 1, []
        for p in parts:
            pieces = split(p)
            n += len(pieces)
            rest += [x for x in pieces if x not in single]
        return n - len(rest), rest

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        data, single = shared.value
        ids, split = tasks.Ids(_merges, data), tasks.splitter(pattern)
        for batch in batches:
            out = []
            for part in tasks.slices(batch):
                counted = [others(t, single, split) for t in part]
                known = ids.learn(x for _, rest in counted for x in rest)
                out += [n + sum(len(known[x]) for x in rest) for n, rest in counted]
            yield pd.Series(out, dtype="int64")

    return F.pandas_udf(count, "long").asNondeterministic()


def count_tokens(docs, path, limit=LIMIT, pattern=public_tokenizers.PATTERN):
    """docs with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit); a null text counts as empty.

    Columns of these names are replaced, others pass through.
    """
    rows = docs.withColumn("n_tokens", counter(docs.sparkSession, path, pattern)("text"))
    rows = rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark, sf_dir):
    small_batches(spark)
    counted = count_tokens(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path(VOCABULARY))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")
