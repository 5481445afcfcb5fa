"""Operators over the whole corpus, and the pipeline, against brute force on small tables."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from harrow.llm import bpe, embedding_dedup, line_dedup, minhash_dedup, quality_rules, source_mix
from harrow.llm.graph import components
from harrow.llm.line_tasks import within

WORDS = [f"word{i}" for i in range(400)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a):
        new = [i + 1]
        for j, d in enumerate(b):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def classes(items, linked):
    """The smallest item that each one reaches."""
    out = {}
    for start in sorted(items):
        stack = [] if start in out else [start]
        while stack:
            x = stack.pop()
            if x not in out:
                out[x] = start
                stack += [y for y in items if y not in out and linked(x, y)]
    return out


def test_within_by_force():
    chance = random.Random(3)
    for _ in range(5000):
        a = "".join(chance.choices("abc", k=chance.randint(0, 12)))
        b = list(a)
        for _ in range(chance.randint(0, 4)):
            b[chance.randint(0, len(b)):chance.randint(0, len(b))] = chance.choices("abc", k=chance.randint(0, 1))
        for limit in (0, 1, 2, 3):
            assert within(a, "".join(b), limit) == (distance(a, b) <= limit), (a, b, limit)
    long = "xy" * 500_000  # time and memory stay linear
    assert within("q" + long, long + "q", 2) and not within("q" + long, long + "q", 1)


def test_components(spark):
    chance = random.Random(9)
    pairs = [(chance.randrange(300), chance.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    pairs += [(2000, 2000 + i) for i in range(1, 300)] + [(5, 5), (None, 4)]
    near = defaultdict(set)
    for a, b in pairs:
        if a is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    want = classes(list(near), lambda x, y: y in near[x])
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    assert sorted((r.node, r.component) for r in got.collect()) == sorted(want.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def lines_by_force(docs, limit, least):
    places = []
    for i, text in sorted(docs, key=lambda d: d[0]):
        places += [(i, k, x.strip(" \t\r")) for k, x in enumerate((text or "").split("\n")) if text is not None]
    lines = {x for _, _, x in places if len(x) >= least}
    steps = ((0, limit),) if isinstance(limit, int) else limit

    def linked(a, b):
        most = max(k for n, k in steps if n <= min(len(a), len(b)))
        return abs(len(a) - len(b)) <= most and distance(a, b) <= most

    group, seen, gone = classes(lines, linked), set(), set()
    for i, k, x in places:
        if x in group:
            (gone.add((i, k)) if group[x] in seen else seen.add(group[x]))
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in docs}


def test_lines_by_force(spark):
    chance = random.Random(1)
    base = ["".join(chance.choices("abcdé", k=chance.randint(8, 14))) for _ in range(12)]

    def line():
        x = list(chance.choice(base))
        for _ in range(chance.randint(0, 2)):
            x[chance.randrange(len(x))] = chance.choice(["", "a", "zz"])
        return "".join(x)

    docs = [(i, "\n".join(line() for _ in range(chance.randint(0, 6)))) for i in range(30)]
    docs += [(98, docs[3][1]), (99, None), (100, ""), (101, " \n\t\n"), (102, "x" * 200_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("class", F.lit(1)).withColumn("id", F.lit(2))
    for limit in (0, 1, 2, ((8, 1), (11, 2), (13, 4))):
        want = lines_by_force(docs, limit, 8)
        for block in (500_000, 60):  # whole families, and families dealt by buckets and chunks
            got = line_dedup.dedup_lines(frame, limit, 8, block)
            assert got.columns == ["doc_id", "text", "class", "id", "line_report"]
            assert {r.doc_id: r.text for r in got.collect()} == want
    twice = frame.union(spark.createDataFrame([(None, "a line without id"), (None, "a line without id")], "doc_id long, text string")
                        .withColumn("class", F.lit(1)).withColumn("id", F.lit(2)))
    assert twice.count() == line_dedup.dedup_lines(twice).count()
    assert line_dedup.dedup_lines(frame.limit(0)).count() == 0


def shingles(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_by_force(docs, percent=85):
    sets = {i: shingles(t) for i, t in docs}
    return classes(list(sets), lambda a, b: sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])), sets


def near_docs(chance):
    docs = []
    for _ in range(12):
        words = chance.choices(WORDS, k=chance.randint(30, 90))
        for _ in range(chance.randint(1, 5)):
            docs.append(" ".join(chance.choice(WORDS) if chance.random() < 0.012 else w for w in words))
    docs += [None, "", " \n", "One two", "one TWO", "É one", "é one", docs[0], docs[0].upper()]
    return list(enumerate(docs, 5))


def test_near_by_force(spark):
    docs = near_docs(random.Random(6))
    want, sets = near_by_force(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("bands", F.lit("x"))
    for block in (minhash_dedup.BLOCK, 300):
        got = {r.doc_id: r for r in minhash_dedup.near_duplicates(frame, block=block).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
        assert all(r.n_shingles == len(sets[i]) and r.kept == (want[i] == i) for i, r in got.items())
    odd = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"),
                                 (2**60 + 1, "x y"), (2**60 + 2, None)], frame.select("doc_id", "text").schema)
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in minhash_dedup.near_duplicates(odd).collect())
    assert got == [(-1, -1, True), (-1, -1, True), (1, 1, True), (1, 1, True), *[(2**60 + i, 2**60 + i, True) for i in (1, 2)]]
    assert minhash_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_vectors_by_force(spark):
    chance = random.Random(8)
    vectors = []
    for _ in range(25):
        centre = [chance.gauss(0, 1) for _ in range(16)]
        vectors += [[x + chance.gauss(0, 0.22) for x in centre] for _ in range(chance.randint(1, 8))]
    vectors += [vectors[0], [x * 1e200 for x in vectors[1]], [0.0] * 16, [], None, [float("nan")] * 16, [None] + [1.0] * 15,
                [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0]]
    rows = list(enumerate(vectors))

    def sound(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        m, n = max(map(abs, a)), max(map(abs, b))
        a, b = [x / m for x in a], [x / n for x in b]
        return sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    def linked(i, j):
        a, b = vectors[i], vectors[j]
        return i != j and sound(a) and sound(b) and len(a) == len(b) and cosine(a, b) >= 0.95

    want = classes([i for i, _ in rows], linked)
    links = {i: sum(linked(i, j) for j, _ in rows) for i, _ in rows}
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit(1))
    for chunk in (1024, 3):
        got = {r.vec_id: r for r in embedding_dedup.near_vectors(frame, chunk=chunk, bits=2).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
        assert {i: r.n_links for i, r in got.items()} == links
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


def mix_by_force(docs, levels, weights, share, epochs, seed="mix"):
    """docs: (id, text, path). -> Counter of (id, epoch)."""
    tokens = {i: len((t or "").encode().split()) for i, t, _ in docs}
    leaves = defaultdict(list)
    for i, _, path in docs:
        leaves[path].append(i)
    budgets = {(): sum(tokens.values()) * share[0] // share[1]}
    for depth in range(levels):
        below = {}
        for parent, budget in budgets.items():
            kids = sorted({p[:depth + 1] for p in leaves if p[:depth] == parent})
            room = {k: epochs * sum(tokens[i] for p, own in leaves.items() if p[:depth + 1] == k for i in own) for k in kids}
            weigh = {k: weights[depth].get(k[-1], 1) for k in kids}
            kids.sort(key=lambda k: (room[k] / weigh[k], k))
            level, left, rest = 0, budget, sum(weigh.values())
            for k in kids:
                level = max(level, left / rest)
                left, rest = left - room[k], rest - weigh[k]
            below |= {k: min(room[k], math.floor(level * weigh[k])) for k in kids}
        budgets = below
    out = Counter()
    texts = {i: t for i, t, _ in docs}
    for path, own in leaves.items():
        held = sum(tokens[i] for i in own)
        whole = budgets[path] // held if held else 0
        rest = budgets[path] - whole * held
        for i in own:
            out.update((i, e) for e in range(1, whole + 1))
        if whole < epochs:
            md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
            run = 0
            for i in sorted(own, key=lambda i: (md5(f"{seed}|{whole + 1}|{i}"), md5(texts[i] or ""))):
                run += tokens[i]
                if run > rest:
                    break
                out[(i, whole + 1)] += 1
    return out


def test_mix_by_force(spark):
    chance = random.Random(4)
    docs = [(i, " ".join(chance.choices(WORDS, k=chance.choice([0, 3, 20, 90]))), (chance.choice("aab"), chance.choice("xyyy"))) for i in range(150)]
    docs += [(200, None, ("c", "")), (201, "w " * 5000, ("b", "z"))]
    rows = [(i, t, p[0], p[1] or None) for i, t, p in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, g string, h string").withColumn("tokens", F.lit("clash"))
    for weights, share, epochs in ((({"a": 3}, {"y": 2}), (4, 5), 2), (({}, {}), (1, 10), 1), (({"b": 9}, {}), (3, 1), 2)):
        want = mix_by_force(docs, 2, weights, share, epochs)
        for rows_each in (4096, 5):
            got = source_mix.mix(frame, [F.col("g"), F.col("h")], weights, share, epochs, rows=rows_each)
            assert Counter((r.doc_id, r.mix.epoch) for r in got.collect()) == want


def test_pipeline_by_force(spark, tmp_path):
    chance = random.Random(12)
    docs = [(i, (t + "\nShared line of the site, number one.\n" + t[::-1]) if t and i % 3 else t) for i, t in near_docs(chance)]
    docs += [(90, " ".join(["again and again and so on it goes here"] * 30)), (91, docs[7][1]), (92, docs[7][1] + " x")]
    rows = [(i, t, chance.choice(["en", "de"]), f"src{i % 4}", len(t or "")) for i, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = {r.doc_id for r in quality_rules.rate(frame).where("quality.kept").collect()}
    assert 90 not in kept
    texts = lines_by_force([(i, t) for i, t in docs if i in kept], line_dedup.LIMIT, line_dedup.MIN_CHARS)
    before = dict(docs)
    texts = {i: t for i, t in texts.items() if t == before[i] or t.encode().split()}
    group, _ = near_by_force(list(texts.items()), corpus_pipeline.NEAR_PERCENT)
    texts = {i: t for i, t in texts.items() if group[i] == i}
    where = {r[0]: r for r in rows}
    path = {i: (f"d{ord(where[i][3][-1]) % 4}", where[i][2], where[i][3]) for i in texts}
    mixed = mix_by_force([(i, t, path[i]) for i, t in texts.items()], 3, source_mix.WEIGHTS, source_mix.SHARE, 1)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(bpe.RANKS), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {r.doc_id: r.ids for r in got} == {i: library.encode_ordinary(texts[i]) for i, _ in mixed}
    assert all(r.round_trip for r in got) and got
