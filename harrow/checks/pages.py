"""Checks over page harvest.

``raw_pages`` is templated from orders, so the expected records are written
from the same columns; the given ``pages`` are checked by counts and by regex.
"""

from pyspark.sql import functions as F

from harrow.checks.fixtures import RAW_PAGES, derived, shape_pages, table
from harrow.checks.listings import check
from harrow.functions.text import resolve_url
from harrow.operators import filters, harvest, pages
from harrow.plans import merge

_SITE = "https://site.example.org"
_BASE = "https://base.example.org/db/"
_TAGS = ("p", "a", "li", "b", "h1", "div", "article")


def _shape(spark, sf, shape):
    return pages.parse_pages(derived(spark, sf, shape_pages(shape)))


def _mixed(spark, sf):
    return pages.parse_pages(derived(spark, sf, RAW_PAGES))


def _parsed(spark, sf):
    return pages.parse_pages(table(spark, sf, "pages"))


# k, n: the order and customer key behind each page; r: its shape among mixed pages
_P = "WITH p AS (SELECT o_orderkey AS k, o_custkey AS n, o_orderkey % 4 AS r FROM orders)"


def _expected(select):
    return f"{_P} {select}"


# --- given pages ------------------------------------------------------------

_OPEN_TAGS = "regexp_extract_all(regexp_replace(html, '<script>.*?</script>', '', 'gs'), '<([a-z][a-z0-9]*)', 1)"


@check(
    "node_counts",
    "SELECT page_id, "
    + ", ".join(f"len(list_filter({_OPEN_TAGS}, lambda x: x = '{t}')) AS n_{t}" for t in _TAGS)
    + " FROM pages",
)
def _(spark, sf):
    return pages.node_counts(_parsed(spark, sf), _TAGS)


@check(
    "page_nodes",
    "WITH t AS (SELECT page_id, unnest(['[document]'] || regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1)) AS tag,"
    " generate_subscripts(['[document]'] || regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1), 1) - 1 AS node_id FROM pages)"
    " SELECT page_id, node_id, tag FROM t",
)
def _(spark, sf):
    nodes = pages.page_nodes(_parsed(spark, sf))
    return nodes.select("page_id", F.col("node_id").cast("long").alias("node_id"), "tag")


@check("page_nodes_full")
def _(spark, sf):
    return pages.page_nodes(_parsed(spark, sf))


def _tree(rows):
    """SELECT of one row per node: id, parent, end, depth, tag, attributes, own text, text."""
    return " UNION ALL ".join(
        f"SELECT k AS page_id, {i} AS node_id, {parent} AS parent_id, {end} AS end_id, {depth} AS depth, '{tag}' AS tag,"
        f" {attrs} AS attrs, {own} AS own_text, {whole} AS text FROM p"
        for i, parent, end, depth, tag, attrs, own, whole in rows
    )


_AMOUNT_0 = "'Rs. ' || (k % 900 + 100) || ',000' || chr(10) || 'Deadline: 31/12/2025'"
_WHOLE_0 = f"'Scheme ' || n || 'Helps students & families pay fees.' || {_AMOUNT_0} || 'Apply'"
_WHOLE_3 = (
    "'Research stay ' || n || 'Stay abroadStatus: PhD studentsSubject area: PhysicsApplication deadline: 30 June 2026"
    "€ 1,200 for 24 months'"
)
_TREE_0 = (
    (0, "NULL", 7, 0, "[document]", "''", "''", _WHOLE_0),
    (1, 0, 7, 1, "html", "''", "''", _WHOLE_0),
    (2, 1, 7, 2, "body", "''", "''", _WHOLE_0),
    (3, 2, 7, 3, "div", "''", "''", _WHOLE_0),
    (4, 3, 4, 4, "h3", "''", "'Scheme ' || n", "'Scheme ' || n"),
    (5, 3, 5, 4, "p", "''", *["'Helps students & families pay fees.'"] * 2),
    (6, 3, 6, 4, "div", "''", _AMOUNT_0 + " || chr(10)", _AMOUNT_0),
    (7, 3, 7, 4, "a", "'href=/apply/' || n", "'Apply'", "'Apply'"),
)
_TREE_3 = (
    (0, "NULL", 10, 0, "[document]", "''", "''", _WHOLE_3),
    (1, 0, 10, 1, "html", "''", "''", _WHOLE_3),
    (2, 1, 10, 2, "body", "''", "''", _WHOLE_3),
    (3, 2, 10, 3, "div", "''", "''", _WHOLE_3),
    (4, 3, 5, 4, "h3", "''", "''", "'Research stay ' || n"),
    (5, 4, 5, 5, "a", "'href=?type=a&id=' || k", "'Research stay ' || n", "'Research stay ' || n"),
    (6, 3, 6, 4, "p", "''", *["'Stay abroad'"] * 2),
    (7, 3, 7, 4, "span", "''", *["'Status: PhD students'"] * 2),
    (8, 3, 8, 4, "span", "''", *["'Subject area: Physics'"] * 2),
    (9, 3, 9, 4, "span", "''", *["'Application deadline: 30 June 2026'"] * 2),
    (10, 3, 10, 4, "span", "''", *["'€ 1,200 for 24 months'"] * 2),
)


@check("page_node_rows", _expected(f"{_tree(_TREE_0)} UNION ALL {_tree(_TREE_3)}"))
def _(spark, sf):
    """Every column of every node, over the two shapes whose trees differ most."""
    nodes = pages.page_nodes(_shape(spark, sf, 0)).unionByName(pages.page_nodes(_shape(spark, sf, 3)))
    pairs = F.transform(F.map_entries("attrs"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return nodes.withColumn("attrs", F.coalesce(F.array_join(pairs, " "), F.lit("")))


@check(
    "find_all",
    "WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '<li><a[^>]*>([^<]*)</a></li>', 1)) AS text FROM pages)"
    " SELECT page_id, 'li' AS tag, text FROM t",
)
def _(spark, sf):
    return pages.find_all(_parsed(spark, sf), "li").select("page_id", "tag", "text")


# --- page shapes ------------------------------------------------------------


@check(
    "main_content",
    "SELECT o_orderkey AS page_id, CASE o_orderkey % 4 WHEN 1 THEN 'article' WHEN 2 THEN 'div' ELSE 'body' END AS tag"
    " FROM orders",
)
def _(spark, sf):
    parsed = _mixed(spark, sf)
    node = pages.main_content(F.col("nodes"), harvest.SCHEME_CONTENT)
    return parsed.select("page_id", node["tag"].alias("tag"))


@check("page_title", _expected(
        "SELECT * FROM (SELECT k AS page_id, CASE r WHEN 2 THEN 'Award ' || n END AS title FROM p) WHERE title IS NOT NULL"
    ),
)
def _(spark, sf):
    return harvest.page_title(_mixed(spark, sf))


@check(
    "heading_next_para",
    "SELECT o_orderkey AS page_id, CASE o_orderkey % 4 WHEN 0 THEN 'Scheme ' || o_custkey"
    " WHEN 1 THEN 'Student grant scheme ' || o_custkey WHEN 2 THEN 'Eligibility' ELSE 'Research stay ' || o_custkey END"
    " AS heading, CASE o_orderkey % 4 WHEN 0 THEN 'Helps students & families pay fees.' WHEN 1 THEN CASE o_orderkey % 3"
    " WHEN 0 THEN 'A scholarship paragraph here.' WHEN 1 THEN 'A bursary paid by 1/2/2026 for some.'"
    " ELSE 'Plain text only.' END WHEN 2 THEN 'Eligible countries: Sri Lanka' ELSE 'Stay abroad' END AS next_text"
    " FROM orders",
)
def _(spark, sf):
    parsed = _mixed(spark, sf)
    return harvest.heading_next(parsed, ("h2", "h3"), ("p",)).drop("node_id")


@check(
    "node_text",
    _expected(
        "SELECT k AS page_id, 'Research stay ' || n || 'Stay abroadStatus: PhD studentsSubject area: Physics'"
        " || 'Application deadline: 30 June 2026€ 1,200 for 24 months' AS joined,"
        " 'Research stay ' || n || ' | Stay abroad | Status: PhD students | Subject area: Physics'"
        " || ' | Application deadline: 30 June 2026 | € 1,200 for 24 months' AS piped FROM p",
    ),
)
def _(spark, sf):
    parsed = _shape(spark, sf, 3)
    body, strings = pages.first(pages.tagged(F.col("nodes"), "body")), F.col("strings")
    return parsed.select(
        "page_id", pages.text(strings, body).alias("joined"), pages.piped_text(strings, body).alias("piped")
    )


@check(
    "container_text",
    _expected(
        "SELECT k AS page_id, 'Scheme ' || n || 'Helps students & families pay fees.Rs. ' || (k % 900 + 100) || ',000'"
        " || chr(10) || 'Deadline: 31/12/2025' || chr(10) || 'Apply' AS container_text FROM p",
    ),
)
def _(spark, sf):
    return harvest.container_text(_shape(spark, sf, 0), "h3").drop("node_id")


@check(
    "lead_paragraphs",
    _expected(
        "SELECT * FROM (SELECT k AS page_id, CASE WHEN r = 2 THEN 'First para. Second para.' WHEN r = 1 THEN CASE k % 3"
        " WHEN 0 THEN 'A scholarship paragraph here.' WHEN 1 THEN 'A bursary paid by 1/2/2026 for some.'"
        " ELSE 'Plain text only.' END END AS lead FROM p) WHERE lead IS NOT NULL",
    ),
)
def _(spark, sf):
    return harvest.lead_paragraphs(_mixed(spark, sf))


@check(
    "article_links",
    _expected(
        "SELECT min(k) AS page_id, link FROM (SELECT k, CASE r WHEN 1 THEN '/s/' || n END AS link FROM p)"
        " WHERE link IS NOT NULL GROUP BY link"
    ),
)
def _(spark, sf):
    return harvest.article_links(_mixed(spark, sf)).drop("node_id")


@check("dedup_links", _expected("SELECT min(k) AS page_id, '/apply/' || n AS link FROM p GROUP BY n"))
def _(spark, sf):
    rows = F.transform(
        pages.links(F.col("nodes")),
        lambda n: F.struct(n["id"].alias("node_id"), n["attrs"]["href"].alias("link")),
    )
    found = _shape(spark, sf, 0).select("page_id", F.inline(rows))
    return harvest.first_seen_links(found, harvest.PLACE).drop("node_id")


def _hrefs(parsed):
    links = F.transform(pages.links(F.col("nodes")), lambda n: n["attrs"]["href"])
    return parsed.select("page_id", F.explode(links).alias("href"))


@check(
    "link_prefix",
    _expected(
        "SELECT * FROM (SELECT k AS page_id, CASE r WHEN 3 THEN '?type=a&id=' || k END AS href FROM p)"
        " WHERE href IS NOT NULL"
    ),
)
def _(spark, sf):
    found = _hrefs(_mixed(spark, sf))
    return found.where(filters.has_link_prefix(F.col("href")))


_HREF_SQL = "SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS href FROM pages"


@check(
    "resolve_url",
    f"WITH t AS ({_HREF_SQL}) SELECT page_id, href, CASE WHEN starts_with(href, 'http') THEN href"
    f" WHEN starts_with(href, '/') THEN '{_SITE}' || href ELSE 'N/A' END AS link FROM t",
)
def _(spark, sf):
    return _hrefs(_parsed(spark, sf)).withColumn("link", resolve_url(F.col("href"), _SITE))


@check(
    "requirement_items",
    _expected(
        "SELECT k AS page_id, unnest(CASE r WHEN 2 THEN ['GPA above 2.0', 'Full-time degree'] END) AS text FROM p"
    ),
)
def _(spark, sf):
    items = pages.find_all(_mixed(spark, sf), "li")
    return items.where(filters.is_requirement_item(F.col("text"))).select("page_id", "text")


_ELIGIBILITY = (
    "'Eligible countries: Sri Lanka' || chr(10) || 'Eligibility Criteria:' || chr(10) || '• GPA above 2.0'"
    " || chr(10) || '• Full-time degree' || chr(10) || '- own laptop'"
)


@check("eligibility_section", _expected(f"SELECT k AS page_id, {_ELIGIBILITY} AS eligibility FROM p"))
def _(spark, sf):
    return harvest.eligibility_section(_shape(spark, sf, 2))


def _records(df):
    return df.drop("node_id", "scrape_date")


def _source(shape):
    return F.lit(f"feed {shape}")


_NA = ", ".join("'N/A' AS {}".format(c) for c in ("eligibility", "contact"))
_FIRST = "JOIN (SELECT {key} AS n0, min(k) AS k FROM p GROUP BY 1) f USING (k)"


@check(
    "harvest_headings",
    _expected(
        f"SELECT k AS page_id, 'Scheme ' || n AS name, 'Helps students & families pay fees.' AS description, {_NA},"
        " 'Rs. ' || (k % 900 + 100) || ',000' AS funding_amount, 'Deadline: 31/12/2025' AS deadline,"
        f" '{_SITE}/apply/' || n AS application_url, 'feed 0' AS source,"
        " 'https://feed0.example.org/p/' || k AS url FROM p " + _FIRST.format(key="n"),
    ),
)
def _(spark, sf):
    return _records(harvest.harvest_headings(_shape(spark, sf, 0), _source(0), _SITE))


_CASCADE_NAME = (
    "CASE k % 3 WHEN 0 THEN 'Grant no ' || n || ' of LKR 5,000' WHEN 1 THEN 'A bursary paid by 1/2/2026 for some.'"
    " ELSE 'Student grant scheme ' || n END"
)


@check(
    "harvest_cascade",
    _expected(
        f"SELECT k AS page_id, {_CASCADE_NAME} AS name,"
        f" CASE k % 3 WHEN 2 THEN 'Plain text only.' ELSE '' END AS description, {_NA},"
        " CASE k % 3 WHEN 0 THEN 'LKR 5,000' ELSE 'N/A' END AS funding_amount,"
        " CASE k % 3 WHEN 1 THEN '1/2/2026' ELSE 'N/A' END AS deadline, 'N/A' AS application_url, 'feed 1' AS source,"
        " 'https://feed1.example.org/p/' || k AS url FROM p " + _FIRST.format(key=_CASCADE_NAME),
    ),
)
def _(spark, sf):
    return _records(harvest.harvest_cascade(_shape(spark, sf, 1), _source(1)))


@check(
    "harvest_articles",
    _expected(
        "SELECT k AS page_id, 'Award ' || n AS name, 'First para. Second para.' AS description,"
        f" {_ELIGIBILITY} AS eligibility, 'N/A' AS contact, 'N/A' AS funding_amount, '15 March 2026' AS deadline,"
        " 'https://feed2.example.org/p/' || k AS application_url, 'feed 2' AS source,"
        " 'https://feed2.example.org/p/' || k AS url FROM p",
    ),
)
def _(spark, sf):
    return _records(harvest.harvest_articles(_shape(spark, sf, 2), _source(2)))


_LISTING_PAGES = """
SELECT o_orderkey AS page_id, 'https://list.example.org/' || cast(o_orderkey AS string) AS url,
  '<article><h2>Award</h2><a href="https://feed2.example.org/p/' || cast(o_custkey AS string) || '">more</a></article>' AS html
FROM orders
"""


@check(
    "follow_links",
    _expected(
        "SELECT k AS page_id, 'Award ' || n AS name, '15 March 2026' AS deadline, 'feed 2' AS source,"
        " 'https://feed2.example.org/p/' || k AS url FROM p WHERE k IN (SELECT n FROM p)",
    ),
)
def _(spark, sf):
    """Listing pages, the links on them, and the records of the pages behind these."""
    links = harvest.article_links(pages.parse_pages(derived(spark, sf, _LISTING_PAGES)))
    found = pages.parse_pages(harvest.follow_links(derived(spark, sf, shape_pages(2)), links))
    return harvest.harvest_articles(found, _source(2)).select("page_id", "name", "deadline", "source", "url")


def _entries(spark, sf):
    return harvest.harvest_entries(
        _shape(spark, sf, 3), _source(3), _BASE, contact="desk", country="there", languages="any"
    )


@check(
    "harvest_entries",
    _expected(
        "SELECT k AS page_id, 'Research stay ' || n AS name, 'Stay abroad' AS description,"
        " '• Status: PhD students' || chr(10) || '• Subject: Physics' AS eligibility, 'desk' AS contact,"
        " '€1,200 per month' AS funding_amount, '30 June 2026' AS deadline,"
        f" '{_BASE}?type=a&id=' || k AS application_url, 'feed 3' AS source,"
        " 'https://feed3.example.org/p/' || k AS url, 'PhD students' AS status, 'Physics' AS subject_area,"
        " 'Doctoral/PhD' AS study_level, 'Research Grant' AS program_type, '24 month' AS duration,"
        " 'PhD students' AS target_group, 'there' AS country, 'any' AS language_requirements FROM p",
    ),
)
def _(spark, sf):
    return _records(_entries(spark, sf))


def _ingested(spark, sf):
    """The four harvests staged and merged; jobs run while the frame is built."""
    registry = [
        merge.Feed("headings", lambda s: harvest.harvest_headings(_shape(s, sf, 0), _source(0), _SITE)),
        merge.Feed("cascade", lambda s: harvest.harvest_cascade(_shape(s, sf, 1), _source(1))),
        merge.Feed("articles", lambda s: harvest.harvest_articles(_shape(s, sf, 2), _source(2))),
        merge.Feed("entries", lambda s: _entries(s, sf)),
    ]
    return merge.ingest(spark, registry, harvest.PLACE)


@check(
    "merge_feeds",
    _expected(
        f"""SELECT source, count(DISTINCT name) AS n FROM (
SELECT 'feed 0' AS source, 'Scheme ' || n AS name FROM p UNION ALL SELECT 'feed 1', {_CASCADE_NAME} FROM p
UNION ALL SELECT 'feed 2', 'Award ' || n FROM p UNION ALL SELECT 'feed 3', 'Research stay ' || n FROM p)
GROUP BY source"""
    ),
)
def _(spark, sf):
    return _ingested(spark, sf).by_source


_HARVESTED = " UNION ALL ".join(
    f"SELECT {name} AS name, 'feed {i}' AS source, {amount} AS funding_amount, {deadline} AS deadline,"
    f" 'https://feed{i}.example.org/p/' || k AS url, k FROM p"
    for i, (name, amount, deadline) in enumerate((
        ("'Scheme ' || n", "'Rs. ' || (k % 900 + 100) || ',000'", "'Deadline: 31/12/2025'"),
        (_CASCADE_NAME, "CASE k % 3 WHEN 0 THEN 'LKR 5,000' ELSE 'N/A' END", "CASE k % 3 WHEN 1 THEN '1/2/2026' ELSE 'N/A' END"),
        ("'Award ' || n", "'N/A'", "'15 March 2026'"),
        ("'Research stay ' || n", "'€1,200 per month'", "'30 June 2026'"),
    ))
)


@check(
    "merge_records",
    _expected(
        f"SELECT name, source, funding_amount, deadline, url FROM ({_HARVESTED})"
        " QUALIFY row_number() OVER (PARTITION BY name, source ORDER BY k) = 1"
    ),
)
def _(spark, sf):
    """Every merged record of the four harvests, so the first of each repeat with its own cells."""
    return _ingested(spark, sf).table.select("name", "source", "funding_amount", "deadline", "url")
