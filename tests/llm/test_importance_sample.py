"""Resampling towards a target distribution against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from harrow.llm import importance_sample


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_force(docs, target, grams, buckets, percent, least, seed):
    def features(text):
        w = words_of(text)
        return [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, grams + 1) for i in range(len(w) - k + 1)]

    own = [features(t) for _, t in docs]
    s, t = Counter(x for f in own for x in f), Counter(x for y in target for x in features(y))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for (i, text), f in zip(docs, own, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in f)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = [k for k, (_, text) in enumerate(docs) if len(words_of(text)) >= least]
    fit.sort(key=lambda k: (-rows[k][3], docs[k][0] is not None, docs[k][0] or 0))
    for rank, k in enumerate(fit[:len(fit) * percent // 100], 1):
        rows[k][4] = rank
    return sorted(map(tuple, rows), key=repr)


def test_resample_by_force(spark):
    chance = random.Random(9)
    words = [f"word{i}" for i in range(80)] + ["É", "été", "日本", "a"]
    lines = [" ".join(chance.choices(words, k=chance.randint(1, 9))) for _ in range(25)] + ["", " ...\t", "Word1, WORD2!"]
    docs = [(i, "\n".join(chance.choices(lines, k=chance.randint(0, 12)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "\n\n..."), (None, "\r\n".join(lines)), (503, lines[0] * 3000), (504, "\n".join([lines[1]] * 3000)),
             (17, docs[17][1]), (17, docs[17][1]), (18, docs[19][1])]
    target = ["\n".join(lines[:9]), "word3 word4\nword5", None, ""]
    frame = spark.createDataFrame([(*d, 1.0, "x") for d in docs], "doc_id long, text string, score double, line string")
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, line int")
    for grams, buckets, percent, least in ((1, 10_000, 10, 20), (3, 97, 40, 5), (2, 1000, 100, 0)):
        got = importance_sample.resample(frame, aim, grams, buckets, percent, least, seed=7)
        assert sorted(map(tuple, got.collect()), key=repr) == by_force(docs, target, grams, buckets, percent, least, 7)
    assert importance_sample.resample(frame.limit(0), aim).count() == 0
    assert importance_sample.resample(frame, aim.limit(0)).count() == len(docs)
