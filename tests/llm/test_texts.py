"""Operators on single texts: libraries, hand-written pages, and rows out of the ordinary."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from harrow.llm import bpe, html_extract, license_scan, preference_format, quality_rules, source_mix, token_counts
from harrow.llm.html_tasks import cut, main_text
from harrow.llm.quality_tasks import longest_repeats, repeats

RANKS = public_tokenizers.path(bpe.RANKS)
VOCABULARY = public_tokenizers.path(token_counts.VOCABULARY)
PARTS = ["a", "é", "ß", " ", "  ", "\n", "\r\n", "\t", "1", "²", "'s", "'LL", "<|endoftext|>", "<|endof", "#", "漢字", " ",
         "😀", "ا", "é", "\x1c", "\x00", " ", "ing", "the ", "tion", "ABC", "_", "-"]


def odd_texts():
    chance = random.Random(5)
    made = ["".join(chance.choices(PARTS, k=chance.randint(0, 30))) for _ in range(300)]
    return [*made, "", None, "a" * 3000, "#" * 2000, "ab" * 700, " " * 500, "é" * 900, made[0]]


@pytest.fixture(scope="module")
def odd(spark):
    rows = list(enumerate(odd_texts()))
    rows += [(None, "no id"), (3, rows[3][1])]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("clash")).repartition(3)


def test_bpe_as_tiktoken(odd):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [r.text or "" for r in odd.collect()]
    ids = [library.encode_ordinary(t) for t in texts]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((len(x), sha(",".join(map(str, x)).encode()), sha(t.encode())) for x, t in zip(ids, texts, strict=True))
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(odd, RANKS).collect()) == want
    apart = bpe.decode_texts(bpe.encode_texts(odd, RANKS), RANKS)
    assert {"n_words", "ids", "decoded"} < set(apart.columns)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in apart.collect())


def test_counts_as_tokenizers(odd):
    library = Tokenizer.from_file(VOCABULARY)
    for r in token_counts.count_tokens(odd, VOCABULARY).collect():
        text = r.text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(text.encode()), n > 512), repr(text)[:80]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert bpe.digests(docs, RANKS).count() == 0
    assert token_counts.count_tokens(docs, VOCABULARY).count() == 0
    assert quality_rules.rate(docs).count() == 0
    assert license_scan.scan(docs).count() == 0
    assert source_mix.mix(docs, source_mix.tree_levels()).count() == 0
    assert html_extract.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert preference_format.format_pairs(preference_format.stale_replies(preference_format.conversations_of(turns))).count() == 0


def longest_by_force(codes):
    n, best = len(codes), [0] * len(codes)
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and codes[i + k] == codes[j + k]:
                k += 1
            best[i] = max(best[i], k)
    return best


def test_longest_repeats_by_force():
    import numpy as np

    chance = random.Random(2)
    for _ in range(200):
        codes = [chance.randrange(chance.choice([1, 2, 4])) for _ in range(chance.randint(1, 30))] + [99]
        assert longest_repeats(np.array(codes)).tolist() == longest_by_force(codes)
    thrice, covered, longest = repeats([[], ["a"] * 5, list("abcxabc"), list("abc")], 4)
    assert (thrice.tolist(), covered.tolist(), longest.tolist()) == ([0, 5, 6, 0], [0, 5, 0, 0], [0, 4, 3, 0])


def test_quality_on_odd_rows(odd):
    rated = quality_rules.rate(odd)
    assert rated.columns == ["doc_id", "text", "n_words", "quality"]
    rows = {(r.doc_id, r.text): r.quality for r in rated.collect()}
    assert rows[(None, "no id")].n_words == 2 and rows[(301, None)].n_words == 0 and rows[(301, None)].base_failed
    assert rated.count() == odd.count()


def test_quality_verdicts(spark):
    clean = " ".join(f"w{i}" for i in range(200))
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, clean), (2, f"{clean} {passage} x {passage}"), (3, f"{passage} y {passage} z {passage} q"), (4, clean[:99]),
            (5, " ".join(f"v{i}" for i in range(120)) + " m " + " ".join(f"v{i}" for i in range(120)) + " " + clean * 5)]
    got = {r.doc_id: r.quality for r in quality_rules.rate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].kept for i in range(1, 6)] == [True, True, False, False, False]
    assert got[2].n_covered == 80 and got[5].longest_repeat > 100


def test_license_spans(spark):
    apache = dict(license_scan.NOTICES)["apache"]
    rows = [(1, "Intro. Licensed under the Apache License, Version 2.0. End"), (2, "MIT License and the mit-license"),
            (3, "the General Public License"), (4, None), (5, ""), (None, "Released under the MIT License."),
            (6, apache.replace("with", "in with")), (6, "x"), (7, "Kit license"), (7, "Kit license"),
            (8, "İmit license"), (9, "licensed under something under the apache")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("w", F.lit(1)).withColumn("hash", F.lit(2))
    got = [(r.doc_id or 0, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels)
           for r in license_scan.scan(docs).collect()]
    assert (1, 10, 1, 4, 4, "apache", "apache") in got and (2, 6, 2, 0, 4, "mit", "mit") in got
    assert (3, 4, 1, 1, 1, "gpl", "gpl") in got and (4, 0, 0, None, None, "", "") in got
    assert (0, 5, 1, 3, 3, "mit", "mit") in got and got.count((7, 2, 0, None, None, "", "")) == 2
    assert (6, len(apache.split()) + 1, 0, None, None, "", "apache") in got
    assert len(got) == len(rows)


PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1><nav><a href=/>Home</a></nav></header>
<div id="cookie-notice">We use cookies.</div><div class="layout sidebar-page"><main><article class="post">
<header><h2>Title here</h2><p class=by>By X</p></header><p>Hello &lt;world&gt; &amp; all.<div class="ad">Buy now</div>
<p>Second para <a href=x>link</a> text<br>more.<ul><li>one item<li>two item</ul><aside>Related</aside>
<form><label>Mail</label><input></form><script>var t="</p>";</script></article>
<section id="comments"><p>Nice article, I liked it a lot, really.</p></section></main></div><footer>&copy; X</footer>"""


def test_pages(spark):
    want = "Title here\nHello <world> & all.\nSecond para link text more.\none item\ntwo item"
    rows = [(1, PAGE), (2, None), (3, ""), (4, "<"), (5, "<article><p>Cut off &am"), (5, "<article><p>Cut off &am")]
    got = [(r.page_id, r.text, r.n_chars) for r in html_extract.extract(
        spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit(1))).orderBy("page_id").collect()]
    assert got == [(1, want, len(want)), (2, "", 0), (3, "", 0), (4, "", 0), (5, "Cut off &am", 11), (5, "Cut off &am", 11)]
    free = main_text("<div id=menu><a href=1>Home</a></div><div><h1>News of the day</h1><div>" + "Many words in one sentence here. " * 5
                     + "</div></div><div><a href=x>Next</a></div>")
    assert free.startswith("News of the day\nMany words") and "Next" not in free and "Home" not in free
    assert main_text("<p>x " * 3000).count("\n") in range(3000)


def test_cut_is_minimal():
    chance = random.Random(4)
    for _ in range(150):
        n = chance.randint(1, 8)
        cost = [chance.randint(-9, 9) for _ in range(n)]
        links = [(i, i + 1, chance.randint(0, 6)) for i in range(n - 1)]

        def price(side):
            against = sum(abs(c) for c, s in zip(cost, side, strict=True) if s != (c > 0))
            return against + sum(w for i, j, w in links if side[i] != side[j])

        least = min(price([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert price(cut(cost, links)) == least


def test_preferences(spark):
    turn = "array<struct<role:string,text:string>>"
    rows = [(1, [("user", "hi"), ("assistant", "a")], [("user", "hi"), ("assistant", "b"), ("user", None)]), (2, None, []),
            (3, [("user", "x")], [("user", "x")]), (None, [(None, None)], [("assistant", "z")])]
    pairs = spark.createDataFrame(rows, f"conv_id long, chosen {turn}, rejected {turn}").withColumn("n", F.lit(1))
    got = {r.conv_id: r for r in preference_format.format_pairs(pairs).collect()}
    assert got[1].prompt == "<|user|>\nhi<|end|>\n" and got[1].chosen == "<|assistant|>\na<|end|>\n"
    assert [tuple(m) for m in got[1].chosen_mask] == [(14, False), (9, True)]
    assert got[1].rejected.endswith("<|user|>\n<|end|>\n")
    assert sum(m.n_chars for m in got[1].rejected_mask) == len(got[1].rejected)
    assert (got[2].prompt, got[2].chosen, got[2].n_prompt_turns) == ("", "", 0)
    assert got[3].n_prompt_turns == 1 and got[3].chosen == got[3].rejected == ""
    assert got[None].n_prompt_turns == 0
