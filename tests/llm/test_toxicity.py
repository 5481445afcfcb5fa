"""Restoring of disguised words against all readings, and toxicity by held-out labels."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from harrow.llm import toxicity
from harrow.llm import toxicity_tasks as tasks

CLEAN = "the river runs past old stone houses where people meet and talk about bread weather school music light garden winter".split()
RUDE = ["idiot", "stupid", "moron", "loser"]


def text(chance, rude=()):
    words = chance.choices(CLEAN, k=40)
    for w in rude:
        words.insert(chance.randrange(len(words)), w)
    return " ".join(words)


def table_of(texts):
    counts = Counter()
    for t in texts:
        for w in tasks.WORD.findall(t.lower()):
            codes = [0, 0, *map(tasks.code, w), 0]
            counts.update((a * tasks.SIZE + b) * tasks.SIZE + c for a, b, c in zip(codes, codes[1:], codes[2:]))
    return tasks.costs(np.array(list(counts)), np.array(list(counts.values()), float))


@pytest.fixture(scope="module")
def table():
    chance = random.Random(1)
    return table_of([text(chance, RUDE) for _ in range(50)])


def test_costs_are_probabilities(table):
    assert np.allclose(np.exp(-table).sum(2), 1)


def test_decoding_finds_the_cheapest_reading(table):
    def price(parts):
        a = b = 0
        total = 0.0
        for piece, cost in parts:
            total += cost
            for c in piece:
                z = tasks.code(c)
                total += table[a][b][z] if z or b else 0.0
                a, b = (b, z) if z else (0, 0)
        return total + (table[a][b][0] if b else 0.0)

    chance, restorer = random.Random(2), tasks.Restorer(table)
    for _ in range(200):
        token = "".join(chance.choices("1d0t5$aeé!", k=chance.randint(1, 6)))
        lattice = restorer.lattice(token) + chance.choice([[], [[("", 0.1), (" ", 3.0)]], restorer.lattice("ooo")])
        best = min(price(p) for p in itertools.product(*lattice))
        found = restorer.decode(lattice)
        assert any("".join(x for x, _ in p) == found and price(p) <= best + 1e-9 for p in itertools.product(*lattice))


@pytest.mark.parametrize("disguised, plain", [
    ("You id10t!", "you idiot!"), ("$tupid m0r0n", "stupid moron"), ("idiooooot", "idiot"), ("i d i o t", "idiot"),
    ("what, i.d.i.o.t, s-t-u-p-i-d.", "what, idiot, stupid."), ("1 d 1 0 t", "idiot"), ("5tuuuup1d", "stupid"), ("l0000ser", "loser"),
    ("The river, 12 houses in 1999.", "the river, 12 houses in 1999."), ("", ""), ("!!! 000 ...", "!!! 000 ..."), ("É x", "é x")])
def test_restored(table, disguised, plain):
    assert tasks.Restorer(table).text(disguised) == plain


def test_model_counts_all_texts(spark, table):
    chance = random.Random(1)
    texts = [(text(chance, RUDE),) for _ in range(50)] + [(None,), ("",)]
    assert np.allclose(toxicity.character_costs(spark.createDataFrame(texts, "text string")), table)
    restored = toxicity.restore(spark.createDataFrame([("An id10t",), (None,)], "text string"), table)
    assert [r.restored for r in restored.collect()] == ["an idiot", None]


def rows_of(n):
    chance = random.Random(3)
    hide = {"idiot": "1d10t", "stupid": "s t u p i d", "moron": "mooooron", "loser": "l0$er"}
    rows, labels = [], []
    for i in range(n):
        toxic, out = int(chance.random() < 0.25), zlib.crc32(str(i).encode()) % 5 == 0
        rude = chance.sample(RUDE, 2) if toxic else []
        rows.append((i, text(chance, [hide[w] for w in rude] if out else rude), 1.0))
        labels.append((i, toxic, None))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = rows_of(400)
    truth = {i: y for i, y, _ in labels}
    rows += [(1000, None, 1.0), (1001, "", 1.0), (1002, "mooooron " * 20_000, 1.0), (None, "an 1d10t", 1.0), (7, rows[7][1], 1.0)]
    labels += [(None, 1, None), (5000, None, None), (5001, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    got = toxicity.score(docs, marks).collect()
    assert len(got) == len(rows) and got[0].score == 1.0
    for r in got:
        assert r.toxicity.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.toxicity.score <= 1 and r.toxicity.predicted == int(r.toxicity.score >= 0.5)
        if r.doc_id in truth:
            assert r.toxicity.predicted == truth[r.doc_id], r
    seen = {r.doc_id: r.toxicity for r in got}
    assert seen[1000].predicted == seen[1001].predicted == 0 and seen[1002].n_restored == 1
    # labels of held-out documents change nothing
    flipped = marks.withColumn("toxic", marks["toxic"] * 0 + 1).where(toxicity.held_out(marks["doc_id"])).unionByName(
        marks.where(~toxicity.held_out(marks["doc_id"])))
    again = {r.doc_id: r.toxicity.score for r in toxicity.score(docs, flipped).collect()}
    assert again == {i: t.score for i, t in seen.items()}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.toxicity.predicted for r in toxicity.score(docs, labels).collect()] == [0, 0]
    assert toxicity.score(docs.limit(0), labels).count() == 0
