"""Page trees and harvest on hand-written pages."""

import random

import pytest
from pyspark.sql import functions as F

from harrow.operators import harvest, pages
from harrow.operators.page_tree import _Trees


def _tree(html):
    trees = _Trees()
    trees.add(html)
    nodes, strings, owners = (c.to_pylist()[0] for c in trees.columns())
    return nodes, strings, owners


def _shape(html):
    return [(n["tag"], n["parent"], n["last"]) for n in _tree(html)[0][1:]]


@pytest.mark.parametrize("html, want", [
    ("<p>a<p>b</p>c", [("p", 0, 2), ("p", 1, 2)]),                       # no implied close
    ("<b><i>x</b>y</i>", [("b", 0, 2), ("i", 1, 2)]),                    # an end tag pops what is open above it
    ("</p><br></br><br/>t", [("br", 0, 1), ("br", 0, 2)]),               # stray ends are ignored, voids close
    ("<div/><p>x", [("div", 0, 1), ("p", 0, 2)]),                        # self-closing form closes any tag
    ("<UL><LI>a</li></ul>", [("ul", 0, 2), ("li", 1, 2)]),
    ("", []),
    (None, []),
])
def test_tree_shape(html, want):
    assert _shape(html) == want


@pytest.mark.parametrize("html, strings", [
    ("a<!-- no --> b", ["a", " b"]),
    ("<script>var t='</p>';</script><style>p{}</style>x", ["x"]),
    ("&amp;&lt;&#233;&nbsp;x", ["&<é\xa0x"]),
    ("<p> \n </p><p>  </p>", ["\n", " "]),
    ("<pre> \n </pre>", [" \n "]),
    ("<template><p>t</p></template>u", ["u"]),
    ("1 < 2", ["1 < 2"]),
    ("<p>cut <a href='x", ["cut <a href='x"]),
])
def test_strings(html, strings):
    assert _tree(html)[1] == strings


def test_attributes():
    node = _tree("<a HREF='/x?a=1&amp;b=2' class=\"p q\" disabled href=y>t</a>")[0][1]
    assert dict(node["attrs"]) == {"href": "y", "class": "p q", "disabled": ""}


def test_rejected_page_is_empty():
    nodes, strings, _ = _tree("<p>before</p><![bad[ x")
    assert nodes[0]["tag"] == "[document]"
    assert len(nodes) in (1, 2) and len(strings) <= 3


def _pages(spark, *html):
    rows = [(i, f"https://s.org/{i}", h) for i, h in enumerate(html)]
    return pages.parse_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))


def _rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("page_id", "node_id").collect()]


SOURCE = "feed"


def _src():
    return F.lit(SOURCE)


def test_page_nodes(spark):
    got = pages.page_nodes(_pages(spark, "<div>a<p> b </p>c</div>")).orderBy("node_id").collect()
    assert [(r.node_id, r.parent_id, r.end_id, r.depth, r.tag, r.own_text, r.text) for r in got] == [
        (0, None, 2, 0, "[document]", "", "abc"), (1, 0, 2, 1, "div", "ac", "abc"), (2, 1, 2, 2, "p", " b ", "b"),
    ]


def test_headings(spark):
    out = harvest.harvest_headings(_pages(
        spark,
        "<h3> One </h3><p>short</p><h3>Two</h3><div>long enough text, LKR 7</div><a href='x'>l</a>"
        "<section><h3>Three<a href='/in'>z</a></h3>Rs. 1,000\n Closing soon \n</section><h3></h3>",
        "<h3>One</h3>",
    ), _src(), "https://site")
    assert _rows(out, "page_id", "name", "description", "funding_amount", "deadline", "application_url") == [
        (0, "One", "", "LKR 7", "Closing soon", "N/A"),
        (0, "Two", "long enough text, LKR 7", "LKR 7", "Closing soon", "N/A"),
        (0, "Threez", "", "Rs. 1,000", "Closing soon", "https://site/in"),
    ]


def test_cascade(spark):
    out = harvest.harvest_cascade(_pages(
        spark,
        "<article><ul><li>A grant of USD 5 by 1/2/2026<ul><li>inner award text</li></ul></li></ul><p>A scholarship paragraph</p></article>",
        "<article><ul><li>short</li></ul><p>The bursary of 12 May 2026 here</p><p>short fund</p></article>",
        "<div class='x content'><h2>Student award</h2><div><p>Next.</p></div><h3>Nothing</h3><h4>Loans fund desk</h4></div>",
        "<div class='other'><li>A grant outside of content</li></div>",
        "<article><p>no listing</p></article><article><li>grant in a second article</li></article>",
    ), _src())
    assert _rows(out, "page_id", "name", "description", "funding_amount", "deadline") == [
        (0, "A grant of USD 5 by 1/2/2026inner award text", "", "USD 5", "1/2/2026"),
        (0, "inner award text", "", "N/A", "N/A"),
        (1, "The bursary of 12 May 2026 here", "", "N/A", "12 May 2026"),
        (2, "Student award", "Next.", "N/A", "N/A"),
        (2, "Loans fund desk", "", "N/A", "N/A"),
    ]


def test_articles(spark):
    out = harvest.harvest_articles(_pages(
        spark,
        "<h1>Plain</h1><h1 class='post-title x'>Classed</h1><div class='content'><p>One</p><p>Two</p><p>Three</p>"
        "Email: a@b.c\nAward: $ 2,000\nDeadline: May 5\n</div>",
        "<h1></h1><article>no name</article>",
        "<article>no title</article>",
        "<h1>No content</h1>",
    ), _src())
    assert _rows(out, "page_id", "name", "description", "eligibility", "funding_amount", "deadline", "contact") == [
        (0, "Classed", "One Two", "N/A", "Award: $ 2,000", "May 5", "a@b.c"),
        (3, "No content", "", "N/A", "N/A", "N/A", "N/A"),
    ]


def _eligibility(spark, *html):
    df = harvest.eligibility_section(_pages(spark, *[f"<article>{h}</article>" for h in html]))
    return [r["eligibility"] for r in df.orderBy("page_id").collect()]


def test_eligibility(spark):
    got = _eligibility(
        spark,
        # nested lists repeat their items: once from the outer list, once from the item, once from the inner list
        "<h2>Eligibility</h2><ul><li>outer item<ul><li>inner item</li></ul></li></ul>",
        # the last of several country and subject texts counts, whole containers included
        "<b>Who can qualify</b><div><p>Eligible countries: A</p></div><p>Eligible countries: B</p><p>Subject: Law</p><p>* point</p>",
        # no heading: the country mention and requirement-like items
        "<p>From Sri Lanka</p><ul><li>Good GPA</li><li>other</li><li>" + "pass " * 50 + "</li></ul>",
        # a heading with nothing behind it falls back as well
        "<ul><li>Any degree</li></ul><h4>Requirements</h4>",
        "<p>nothing</p>",
        # result of ten characters or fewer
        "<ul><li>pass</li></ul>",
    )
    assert got == [
        "Eligibility Criteria:\n• outer iteminner item\n• inner item\n• inner item\n• inner item",
        "Eligible countries: B\nSubject: Law\nEligibility Criteria:\n* point",
        "* Eligible Countries: Sri Lanka\n• Good GPA",
        "• Any degree",
        "N/A",
        "N/A",
    ]


def test_eligibility_reach_and_limit(spark):
    far = "<h2>Criteria</h2>" + "<i>x</i>" * 15 + "<p>Eligible countries: far</p>"
    many = "<h2>Criteria</h2><ul>" + "".join(f"<li>item no {i}</li>" for i in range(14)) + "</ul>"
    got = _eligibility(spark, far, many)
    assert got[0] == "N/A"
    assert got[1].split("\n") == ["Eligibility Criteria:"] + [f"• item no {i}" for i in range(10)]


def test_entries(spark):
    out = harvest.harvest_entries(_pages(
        spark,
        "<div><h3><a href='?type=a&id=1'>Study in X</a></h3><span>Status:</span><span>Masters</span>"
        "<span>A text block that is surely longer than fifty characters, EUR 9</span></div>"
        "<div><h3><a href='/other'>No</a></h3></div><div><h3>no link</h3></div>"
        "<div><h3><a name='q'>first</a><a href='?type=a'>second</a></h3></div>",
    ), _src(), "https://db/", "desk", "there", "any")
    assert _rows(out, "name", "status", "subject_area", "eligibility", "description", "funding_amount",
                 "application_url", "study_level", "program_type", "deadline") == [
        ("Study in X", "", "N/A", "• Status: ", "A text block that is surely longer than fifty characters, EUR 9",
         "N/A", "https://db/?type=a&id=1", "N/A", "Study Scholarship", "N/A"),
    ]


def test_links(spark):
    parsed = _pages(
        spark,
        "<article><a name='n'>x</a><a href='/1'>y</a><a href='/2'>z</a></article><article><p>none</p></article>",
        "<article><a href='/1'>again</a></article><article><a href=''>empty</a></article><article><a href='/3'>t</a></article>",
    )
    assert _rows(harvest.article_links(parsed), "page_id", "link") == [(0, "/1"), (1, "/3")]


def test_follow_links(spark):
    listing = _pages(spark, "<article><a href='https://s.org/a'>y</a></article><article><a href='https://s.org/gone'>y</a></article>")
    articles = spark.createDataFrame(
        [(7, "https://s.org/a", "<h1>A</h1>"), (8, "https://s.org/b", "<h1>B</h1>")], "page_id long, url string, html string"
    )
    found = harvest.follow_links(articles, harvest.article_links(listing))
    out = harvest.harvest_articles(pages.parse_pages(found), _src())
    assert _rows(out, "page_id", "name", "application_url") == [(7, "A", "https://s.org/a")]


def test_page_plan_has_no_shuffle(spark):
    plan = harvest.harvest_articles(_pages(spark, "<p>x</p>"), _src())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_next_and_parents_by_position(spark):
    """Each node's next candidate and its parent's place, against a plain search."""
    import random

    from harrow.operators import pages as G

    chance = random.Random(3)
    html = "".join(chance.choice(["<p>a</p>", "<div>", "</div>", "<h3>t</h3>", "<a href=x>l</a>"]) for _ in range(300))
    parsed = G.parse_pages(spark.createDataFrame([(1, "u", html), (2, "u", ""), (3, "u", None)], "page_id long, url string, html string"))
    page = G.once(parsed.withColumn("found", G.tagged(F.col("nodes"), "p", "a")))
    page = page.withColumn("at", G.next_at(F.col("found")))
    parents = F.array_sort(F.array_distinct(F.transform("nodes", lambda n: F.coalesce(n["parent"], F.lit(0)))))
    page = G.once(page.withColumn("parents", parents)).withColumn("parents_at", G.position_at(F.col("parents")))
    seen = page.select("nodes", "parents", F.transform("nodes", lambda n: G.next_of(F.col("found"), F.col("at"), n)["id"]).alias("next"),
                       "parents_at").collect()
    assert len(seen) == 3 and len(seen[0].nodes) > 100
    for row in seen:
        found = [n.id for n in row.nodes if n.tag in ("p", "a")]
        assert row.next == [next((c for c in found if c > n.id), None) for n in row.nodes]
        assert [row.parents[row.parents_at[n.parent or 0]] for n in row.nodes] == [n.parent or 0 for n in row.nodes]


def test_cascade_plan_holds_each_strategy_once(spark):
    from harrow.operators import pages as G

    parsed = G.parse_pages(spark.createDataFrame([(1, "u", "<li>x</li>")], "page_id long, url string, html string"))
    plan = harvest.harvest_cascade(parsed, F.lit("s"), dedup=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_repeat(") == 1  # the next paragraphs, once for each page
    assert plan.count("filter(") < 60


def test_followed_pages_are_not_shuffled(spark):
    pages = spark.range(5).selectExpr("id AS page_id", "concat('u', id) AS url", "repeat('x', 50) AS html")
    links = spark.createDataFrame([("u1",), ("u3",), ("u1",), ("u9",)], "link string")
    followed = harvest.follow_links(pages, links)
    assert sorted(r.url for r in followed.collect()) == ["u1", "u3"]
    plan = followed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_a_page_layout_is_walked_once(monkeypatch):
    """Pages of a layout that was met take its tree, with their own texts and attributes."""
    bits = ["<p>", "</p>", "<a href=\"x&amp;y\" href=\"z\">", "</a>", "text", "&amp;", "&#1;", " ", "\n", "<br>", "<li>", "</li>", ">"]
    chance = random.Random(3)
    html = ["".join(chance.choices(bits, k=chance.randint(0, 6))) for _ in range(20_000)]
    html += ["<pre> </pre>", "<pre> </pre>", "<p><!-- c --></p>", "<style>x</style>", "a<p>", "<p title=\"a > b\">c</p>", "", None] * 2
    met, walked = _Trees(), _Trees()
    for page in html:
        met.add(page)
        walked._add_walked(page)
    assert all(a.equals(b) for a, b in zip(met.columns(), walked.columns(), strict=True))
    times, walk = [], _Trees._walk
    monkeypatch.setattr(_Trees, "_walk", lambda self, page: times.append(page) or walk(self, page))
    trees = _Trees()
    for i in range(100):
        trees.add(f'<ul><li><a href="/{i}">item {i}</a></li></ul>')
    assert len(times) == 1 and len(trees.tags) == 400
