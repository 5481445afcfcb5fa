"""Source divergence audit against brute force."""

import random
import re
from collections import Counter, defaultdict

from harrow.llm import source_audit


def by_force(docs, least, top):
    texts = [tuple(x or "" for x in d) for d in docs]
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    out = set()
    for lang in {d[0] for d in texts}:
        own = [d for d in texts if d[0] == lang]
        held = Counter(t for _, _, text in own for t in set(terms(text)))
        kept = {t for t, n in held.items() if n >= least}
        counts = defaultdict(Counter)
        for _, source, text in own:
            counts[source].update(t for t in terms(text) if t in kept)
        whole = sum(counts.values(), Counter())

        def parts(c):
            return {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}

        q, p = parts(whole), {s: parts(c) for s, c in counts.items()}
        for s in counts:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in counts if o != s]
            more = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, rows, limit in (("pair", pairs, len(pairs)), ("term", more, top)):
                rows.sort(key=lambda r: (-r[1], r[0].encode()))
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(rows[:limit], 1)}
    return out


def test_audit_by_force(spark):
    chance = random.Random(5)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["É", "é", "ß", "x\ny", "A", "a", "b1c", "\U0001F600", "�"]
    docs = []
    for _ in range(160):
        source = chance.choice(["s1", "s2", "s3", "S3", "é", None])
        text = " ".join(chance.choices(words[:20] if source == "s1" else words, k=chance.choice([0, 1, 8, 40])))
        docs.append((chance.choice(["en", "en", "de", None]), source, text))
    docs += [docs[0], docs[0], ("en", "s1", docs[0][2]), ("en", "s9", docs[0][2]), ("de", "s9", docs[0][2])] * 3
    docs += [("en", "none", None), ("en", "empty", " 12 "), ("fr", "alone", "wa wb"), ("it", "x", None), ("it", "y", "q"), ("en", "s2", "wa " * 30_000)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "lang string, source string, text string, n long, term string")
    for least, top, terms, sources in ((3, 50, 4096, 256), (3, 4, 7, 2), (1000, 50, 4096, 256)):
        got = [tuple(r) for r in source_audit.audit(frame, least, top, terms, sources).collect()]
        want = by_force(docs, least, top)
        assert len(got) == len(set(got)) and set(got) == want
    assert {r[2] for r in want} == {"pair"} and {r[4] for r in want} == {0}
    assert source_audit.audit(frame.limit(0)).count() == 0


def test_counts_beyond_64_bits(spark):
    row = spark.createDataFrame([(4 * 10**12, 10**13, 1)], "n long, total long, terms long")
    got = row.select(source_audit._parts(row["n"], "total").alias("p")).first().p
    assert got == 1 + 10**9 * (4 * 10**12 + 5) // (10**13 + 5)
