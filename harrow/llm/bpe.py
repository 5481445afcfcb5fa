"""Byte-level BPE encoding and decoding on length-bucketed numpy matrices."""

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F

from harrow.llm import bpe_tasks as tasks
from harrow.llm.store import documents, small_batches

RANKS = "byte_bpe_multi_50k.tiktoken"


def encoder(spark, path, pattern=public_tokenizers.PATTERN):
    """Column function: text -> array<int> of ids by the ranks in path.

    Each match of pattern is merged on its own; special strings are ordinary
    text. A null or empty text has no ids. The rank file (a vocabulary, fixed in
    size) is read once on the driver and broadcast.
    """
    shared = _shared(spark, path)

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = _encoding(shared.value, pattern)[0]
        for batch in batches:
            yield pd.Series([ids for part in tasks.slices(batch) for ids in run(part)], dtype=object)

    return F.pandas_udf(encode, "array<int>").asNondeterministic()


def decoder(spark, path):
    """Column function: array<int> of ids -> the bytes that they stand for (null or none: no bytes)."""
    shared = _shared(spark, path)

    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = _encoding(shared.value, public_tokenizers.PATTERN)[1]
        for batch in batches:
            yield pd.Series([run(ids) for ids in batch], dtype=object)

    return F.pandas_udf(decode, "binary").asNondeterministic()


def round_trip(spark, path, pattern=public_tokenizers.PATTERN):
    """Column function: text -> struct of its ids and of the bytes that these ids decode to, in one worker."""
    shared = _shared(spark, path)

    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode, decode = _encoding(shared.value, pattern)
        for batch in batches:
            ids = [x for part in tasks.slices(batch) for x in encode(part)]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(map(decode, ids), dtype=object)})

    return F.pandas_udf(both, "ids array<int>, decoded binary").asNondeterministic()


def _encoding(data, pattern):
    """(texts -> list of arrays of ids, ids -> bytes) by a rank file."""
    ids, split = tasks.Ids(tasks.from_ranks, data), tasks.splitter(pattern)
    pieces = ids.merges.pieces

    def encode(texts):
        found = [split(t) for t in texts]
        known = ids.learn(chain.from_iterable(found))
        return [np.fromiter(chain.from_iterable(map(known.__getitem__, p)), np.int32) for p in found]

    def decode(x):
        return b"".join(map(pieces.__getitem__, x.tolist())) if x is not None else b""

    return encode, decode


def _shared(spark, path):
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode_texts(docs, path, ids="ids"):
    """docs with an array<int> column of the text's ids; a column of that name is replaced, others pass through."""
    return docs.withColumn(ids, encoder(docs.sparkSession, path)("text"))


def decode_texts(docs, path, ids="ids", decoded="decoded"):
    """docs with a binary column of the decoded ids."""
    return docs.withColumn(decoded, decoder(docs.sparkSession, path)(ids))


def digests(docs, path):
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of docs."""
    rows = docs.select("doc_id", round_trip(docs.sparkSession, path)("text").alias("done")).select("doc_id", "done.*")
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_byte_bpe(spark, sf_dir):
    small_batches(spark)
    return digests(documents(spark, sf_dir), public_tokenizers.path(RANKS))
