"""Toxicity: disguised words are restored by a noisy channel under a character model, then the restored text is scored."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from harrow.llm import toxicity_tasks as tasks
from harrow.llm.store import documents, small_batches, written

SAMPLE = 20_000  # labelled documents that the classifier is fitted on, at most
FEATURES = 5_000  # words and beginnings of words that it may use, at most
EVIDENCE = 3.0  # standard errors by which a feature must be more frequent in toxic documents
_SEEN = 3  # toxic documents that must hold it


def character_costs(docs):
    """An array of negative log-probabilities of a character after two others, counted over all texts of docs.

    The words of all texts are added up, in the task first; their number grows
    with the texts. Grams are then counted on different words, but for those with
    a letter three times in a row, which may be disguised. What the driver
    gets is a table of fixed size, one cell for each three of SIZE characters.
    """
    texts = docs.where("text is not null").select("text")
    words = texts.mapInArrow(tasks.word_counter, "word string, n long")
    words = words.groupBy("word").agg(F.sum("n").alias("n"))
    grams = words.mapInPandas(tasks.gram_counter, "gram long, n long")
    found = grams.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    return tasks.costs(found["gram"].to_numpy(np.int64), found["n"].to_numpy(float))


def restore(docs, table, column="restored"):
    """docs with a column: the text in lower case, its disguised words restored; null stays null.

    Three disguises are undone, where the character model finds the plain word
    likelier: signs for letters (id10t), letters written three times or more
    (idiooot), and single letters with gaps (i d i o t, i.d.i.o.t).
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restorer = tasks.Restorer(shared.value)
        for batch in batches:
            yield batch.map(restorer.text, na_action="ignore").astype(object)

    return docs.withColumn(column, F.pandas_udf(run, "string").asNondeterministic()("text"))


def held_out(doc_id):
    """Whether a document's label is left for the test: crc32 of its id as text, a fifth of all. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def learn(docs, labels, table, sample=SAMPLE, features=FEATURES):
    """({feature: number}, weights, bias) of a logistic regression on restored words.

    Learned from at most `sample` labelled documents that are not held out,
    those with the smallest hashes of their ids; a doc_id with two labels is
    toxic if either is. Features are words and beginnings of words that toxic
    documents hold clearly more often; at most `features` of them, the clearest.
    """
    spark = docs.sparkSession
    own = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    own = written(own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "sample")
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(own), "doc_id")  # at most `sample` rows
    shared = spark.sparkContext.broadcast(table)
    words = texts.select("toxic", "text").mapInPandas(tasks.word_lists(shared), "toxic int, words array<string>")
    words = written(words, "words")
    total = words.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    toxic, clean = int(total[0]), int(total[1] - total[0])
    counts = words.mapInPandas(tasks.evidence, "feature string, toxic long, clean long")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    c, d = F.lit(toxic) - F.col("toxic") + 0.5, F.lit(clean) - F.col("clean") + 0.5
    clear = F.log(a * d / (b * c)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    chosen = counts.where(F.col("toxic") >= _SEEN).select("feature", clear.alias("clear")).where(F.col("clear") >= EVIDENCE)
    chosen = chosen.orderBy(F.desc("clear"), "feature").limit(features).collect()
    index = {r["feature"]: i for i, r in enumerate(chosen)}
    found = words.mapInPandas(tasks.hit_lists(index), "toxic int, at array<int>, n array<int>").collect()
    rows = sorted((r["toxic"], tuple(r["at"]), tuple(r["n"])) for r in found)
    return index, *tasks.fit(rows, len(index))


def score(docs, labels, sample=SAMPLE, report="toxicity"):
    """docs with a struct column report: held_out, score (0 to 1), predicted, n_restored.

    The score of a text rests on its restored words alone: the character model
    is counted over all texts, the classifier learned as `learn` says. A null or
    empty text has the score of a text without toxic words. n_restored counts
    different disguised words, and the spaced ones of a text as one. Without any
    labelled document nothing is predicted. Every row gets its own result; other
    columns pass through, but one named like the report is replaced.
    """
    table = character_costs(docs)
    index, weights, bias = learn(docs, labels, table, sample)
    shared = docs.sparkSession.sparkContext.broadcast((table, index, weights, bias))
    steps = tasks.scorer(shared)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return steps(batches)

    done = F.pandas_udf(run, "score double, n_restored long").asNondeterministic()
    rows = docs.withColumn(report, done("text"))
    found = F.col(report)
    return rows.withColumn(report, F.struct(
        held_out(F.col("doc_id")).alias("held_out"), found["score"].alias("score"),
        (found["score"] >= 0.5).cast("int").alias("predicted"), found["n_restored"].alias("n_restored")))


def op12_toxicity(spark, sf_dir):
    small_batches(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "toxicity.*")
