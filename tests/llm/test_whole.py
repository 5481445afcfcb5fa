"""What an operator must not leave out: small cases for each cut that a review found."""

import random
import time

import pytest

import corpus_pipeline
from harrow.llm import line_dedup, line_tasks, minhash_dedup
from harrow.llm.html_tasks import blocks, cut, edges, main_text
from tests.llm.test_corpus import WORDS, classes, distance, near_by_force, near_docs, shingles


def test_pipeline_links_near_copies_from_80(spark):
    docs = near_docs(random.Random(6))
    words = random.Random(1).choices(WORDS, k=60)
    docs += [(200, " ".join(words)), (201, " ".join(words[:30] + ["other"] + words[31:]))]
    one, other = (shingles(t) for _, t in docs[-2:])
    assert 0.80 <= len(one & other) / len(one | other) < 0.85
    want, _ = near_by_force(docs, 80)
    assert want[201] == 200 and near_by_force(docs, 85)[0][201] == 201
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    left = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, frame, None).collect()}
    assert left == {i for i in want if want[i] == i}
    for block in (minhash_dedup.BLOCK, 300):
        found = minhash_dedup.near_duplicates(frame, 80, block=block).collect()
        assert {r.doc_id: r.component_id for r in found} == want


def test_bands_follow_from_the_threshold():
    assert minhash_dedup.banding(85) == (21, 6)
    for percent in range(4, 100):
        bands, rows = minhash_dedup.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= minhash_dedup.MISSED and bands * rows <= 256


@pytest.mark.parametrize("tag", [
    'p title="Hidden gems"', 'p data-hidden="false"', "p data-role=navigation", 'p data-id="sidebar"', "p title='class=ad id=menu'",
    'p aria-hidden="false"', 'p data-style="display:none"', 'p title="a > b" lang=en', 'a href="/the-hidden-cost"',
    "a href=/x?class=ad&hidden"])
def test_only_whole_attributes_count(tag):
    assert main_text(f"<article><p>Before.</p><{tag}>The words stay.</{tag[0]}><p>After.</p></article>").split("\n")[1] == "The words stay."


@pytest.mark.parametrize("tag", [
    "p hidden", "p HIDDEN=''", "p title=x hidden", "p aria-hidden=true", 'p style="color:red; display: none"', "p hidden title='a'", "p id='a'hidden"])
def test_hidden_elements_go(tag):
    assert main_text(f"<article><p>Before.</p><{tag}>Not shown.</p><p>After.</p></article>") == "Before.\nAfter."


ONE = "A first sentence of the text with more than a few words in it, so that it is one to read."
TWO = "And a second one that goes on about the same thing for as long as the first one did, or longer."


@pytest.mark.parametrize("page", [
    f'<div class="page has-sidebar"><div class="content"><p>{ONE}<p>{TWO}</div></div>',
    f'<div class="layout no-ads"><p>{ONE}<p>{TWO}</div>',
    f'<div class="page sidebar"><div class="content"><p>{ONE}<p>{TWO}</div></div>',
    f'<div class="sidebar-layout"><div id="content"><p>{ONE}<p>{TWO}</div></div>',
    f'<div id="search-results-page"><p>{ONE}<p>{TWO}</div>'])
def test_one_word_of_a_name_does_not_decide(page):
    assert main_text(page) == f"{ONE}\n{TWO}"


@pytest.mark.parametrize("heading", [
    '<h2 id="search-and-share">How to look</h2>', '<h2 id="comments">How to look</h2>', '<div class="post-header"><h1>How to look</h1></div>',
    '<div class="header"><h1>How to look</h1></div>', '<h2 class="widget-title">How to look</h2>'])
def test_headings_of_an_article_stay(heading):
    assert main_text(f"<article>{heading}<p>{ONE}<p>{TWO}</article>") == f"How to look\n{ONE}\n{TWO}"


def test_header_of_a_post_without_article():
    assert main_text(f'<div><div class="post-header"><h1>How to look</h1></div><p>{ONE}<p>{TWO}</div>') == f"How to look\n{ONE}\n{TWO}"


@pytest.mark.parametrize("name", [
    'class="sidebar"', 'id="cookie-notice"', 'class="box ad"', 'role="navigation"', 'class="comments has-replies"', 'class="social-share"',
    'class="sidebar"><div class="content"', 'class="header"'])
def test_bad_names_still_go(name):
    end = "</div></div>" if "><" in name else "</div>"
    assert main_text(f"<div><p>{ONE}<p>{TWO}<div {name}><p>{TWO}{end}</div>") == f"{ONE}\n{TWO}"
    inside = f"<article><p>{ONE}<div {name}>Buy now{end}<p>{TWO}</article>"
    assert main_text(inside) == f"{ONE}\n{TWO}"


def test_siblings_hold_a_paragraph_between_adverts():
    advert = '<div class="ad"><a href=x>Buy now</a></div>'
    page = f"<div><p>{ONE}<p>{TWO}{advert}<p>{ONE}</p>{advert}<p>{TWO}<p>{ONE}</div>"
    assert main_text(page) == "\n".join([ONE, TWO, ONE, TWO, ONE])
    nested = page.replace(advert, f"<div>{advert * 3}</div>")
    assert main_text(nested) == main_text(page)
    page = "<div>" + f"<p>{ONE}</p>{advert}" * 500 + "</div>"
    assert len(edges(blocks(page))) <= 3 * len(blocks(page))
    assert (0, 2, 6) in edges(blocks(page))


def test_cut_is_minimal_on_edges_of_siblings():
    chance = random.Random(7)
    for _ in range(150):
        n = chance.randint(1, 9)
        cost = [chance.randint(-12, 12) for _ in range(n)]
        links = [(i, j, chance.randint(1, 6)) for j in range(n) for i in {j - 1, chance.randrange(n)} if 0 <= i < j]

        def price(side):
            against = sum(abs(c) for c, s in zip(cost, side, strict=True) if s != (c > 0))
            return against + sum(w for i, j, w in links if side[i] != side[j])

        assert price(cut(cost, links)) == min(price([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))


def test_pipeline_drops_equal_short_lines(spark):
    long = "A line that is long enough to be compared"
    docs = [(1, f"Short one.\n{long}\n\nok\n}}"), (2, f"Short one.\n{long}s\n\nOk\n}}\nok"), (3, " Short one. \nShort one!\n\n")]
    rows = [(i, t, "en", "s", len(t)) for i, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.lines(spark, frame, None).collect()}
    want = {1: docs[0][1], 2: "\nOk", 3: "Short one!\n\n"}
    assert got == {i: (t, len(t)) for i, t in want.items()}
    left = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()}
    assert left == {1: docs[0][1], 2: "Short one.\n\nOk\n}\nok", 3: docs[2][1]}


@pytest.mark.parametrize("page, text", [
    ("<p>Hello there friend.</p><p title=it's>World's end is near.</p><p>More.</p>", "Hello there friend.\nWorld's end is near.\nMore."),
    ("<p>Energy <math><mi>E</mi></math> equals.</p>", "Energy E equals."),
    ("<p>A word <button>Buy</button>and <svg><path/></svg>here.</p>", "A word and here."),
    ("<ul><li>a b<li>c d</ul><p>Short one</p>", "a b\nc d\nShort one"),
    ("<!--><p>Hi there", "Hi there")])
def test_no_text_is_lost(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("start", ["<div>", "<i>x", "<p><table><div>", "<li><b>", "<a>x<p>"])
def test_open_elements_take_linear_time(start):
    taken = []
    for times in (5_000, 20_000):
        page, begun = start * times + ONE, time.process_time()
        blocks(page)
        taken.append(time.process_time() - begun)
    assert taken[1] < 12 * taken[0] + 0.2


def test_cut_of_a_long_page():
    page = f"<div><p>{ONE}</p><div class=ad><a href=x>Buy now</a></div></div>" * 4_000
    begun = time.process_time()
    assert main_text(page) == "\n".join([ONE] * 4_000)
    assert time.process_time() - begun < 20


def reached(nodes, links):
    near = {x: set() for x in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    return classes(nodes, lambda x, y: y in near[x])


@pytest.mark.parametrize("steps", [*[((max(8, k + 1), k),) for k in range(9)], ((8, 1), (16, 2), (24, 4), (40, 8))])
def test_links_of_lines_by_force(steps):
    chance = random.Random(5)
    sorts = line_tasks.length_classes(steps)
    for _ in range(20):
        lines = set()
        for base in ["".join(chance.choices("abcé", k=chance.randint(8, 60))) for _ in range(4)]:
            for _ in range(6):
                x = list(base)
                for _ in range(chance.randint(0, 9)):
                    x[chance.randrange(len(x))] = chance.choice(["", "a", "bc", "d"])
                lines.add("".join(x))
        lines = sorted(x for x in lines if len(x) >= steps[0][0])

        def linked(a, b):
            return distance(a, b) <= max(k for n, k in steps if n <= min(len(a), len(b)))

        found = line_tasks.links(range(len(lines)), lines, sorts)
        assert reached(range(len(lines)), found) == classes(range(len(lines)), lambda a, b: linked(lines[a], lines[b]))


def test_pairs_in_bulk_are_those_one_by_one():
    chance = random.Random(8)
    pairs, limits = [], []
    while len(pairs) < 5000:
        a = "".join(chance.choices("abé", k=chance.randint(0, 30)))
        b = list(a)
        for _ in range(chance.randint(0, 12)):
            b[chance.randint(0, len(b)):chance.randint(0, len(b))] = chance.choices("abé", k=chance.randint(0, 1))
        a, b = sorted((a, "".join(b)), key=len, reverse=True)
        if len(a) - len(b) <= 8:
            pairs.append((a, b))
            limits.append(chance.randint(len(a) - len(b), 8))
    want = [distance(a, b) <= k for (a, b), k in zip(pairs, limits, strict=True)]
    assert line_tasks.within_pairs(pairs, limits).tolist() == want and 500 < sum(want) < 4900


def test_a_changed_word_links_long_lines(spark):
    words = random.Random(2).choices(WORDS, k=50)
    docs = [(1, " ".join(words)), (2, " ".join([*words[:20], "other", *words[21:]])), (3, " ".join(words[:3])),
            (4, " ".join(["other", *words[1:3]]))]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: docs[0][1], 2: "", 3: docs[2][1], 4: docs[3][1]}


def test_lines_of_one_half_take_little_time():
    chance = random.Random(3)
    half, *ends = ("".join(chance.choices("abcdefghij klmno", k=32)) for _ in range(4001))
    begun = time.process_time()
    assert not line_tasks.links(range(4000), [half + x for x in ends], line_tasks.length_classes(line_dedup.LIMIT))
    ends = [half * 8 + half[:x] + "q" + half[x + 1:] for x in range(32)] * 100
    found = line_tasks.links(range(3200), ends, line_tasks.length_classes(line_dedup.LIMIT))
    assert len(found) == 3199 and time.process_time() - begun < 10
