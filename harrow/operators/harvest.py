"""Listing records from parsed pages, one function per page shape."""

from pyspark.sql import functions as F

from harrow.functions import blocks as B
from harrow.functions import patterns as P
from harrow.functions.classify import program_type, study_level
from harrow.functions.text import (
    bullet, has_any, is_bullet, join_lines, keyword_line, labelled_field, let, resolve_url, truncate,
)
from harrow.operators import pages as G
from harrow.operators.dedup import first_seen_links, keep_first_in_feed
from harrow.operators.filters import (
    has_link_prefix, is_heading_candidate, is_item_candidate, is_paragraph_candidate,
    is_requirement_item, is_valid_name,
)
from harrow.schema import COMMON, ENTRY_EXTRAS, NA
from harrow.session import stage_table

# --- fixed values: where each page shape keeps its content ------------------
CASCADE_CONTENT = (("article", None), ("div", ("item-page", "content", "main-content")))
ARTICLE_CONTENT = (("div", ("entry-content", "post-content", "content")), ("article", None))
SCHEME_CONTENT = ARTICLE_CONTENT + (("body", None),)
ARTICLE_TITLE = (("h1", ("entry-title", "post-title")), ("h1", None))
ELIGIBILITY_HEADINGS = ("h2", "h3", "h4", "h5", "strong", "b")
ELIGIBILITY_REACH = 15
# ----------------------------------------------------------------------------

# place of a record in its feed
PLACE = ("page_id", "node_id")


def _nodes():
    return F.col("nodes")


def _strings():
    return F.col("strings")


def _listing(records, source, url, extras=(), **columns):
    """Records as common listings: given columns, the rest N/A."""
    values = {c: F.lit(NA) for c in COMMON}
    values.update(
        description=F.lit(""),
        source=source,
        url=F.col("url") if url is None else url,
        scrape_date=F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    )
    values.update(columns)
    return records.select(*PLACE, *[values[c].alias(c) for c in COMMON + tuple(extras)])


def _with_parent_facts(page, make):
    """Add ``facts`` read off the parents of the nodes ``found``, and where each parent's stand.

    Siblings share a container, so its text is built once and not per sibling.
    """
    parents = F.array_sort(F.array_distinct(F.transform("found", lambda n: n["parent"])))
    page = G.once(page.withColumn("parents", parents))
    facts = F.transform("parents", lambda p: make(G.node_at(_nodes(), p)))
    return page.withColumns({"facts": facts, "parents_at": G.position_at(F.col("parents"))})


def _fact(n):
    return F.get("facts", F.get("parents_at", n["parent"]))


def container_text(parsed, *tags):
    """Text of the parent of each node with one of the tags."""
    found = parsed.select("page_id", "nodes", "strings", G.tagged(_nodes(), *tags).alias("found"))
    texts = _with_parent_facts(found, lambda n: G.raw_text(_strings(), n))
    rows = F.transform("found", lambda n: F.struct(n["id"].alias("node_id"), _fact(n).alias("container_text")))
    return texts.select("page_id", F.inline(rows))


def heading_next(parsed, headings, following):
    """Text of the first following node of some tags, for each heading."""
    page = G.once(parsed.withColumn("later", G.tagged(_nodes(), *following)))
    page = page.withColumn("later_at", G.next_at(F.col("later")))
    rows = F.transform(
        G.tagged(_nodes(), *headings),
        lambda n: F.struct(
            n["id"].alias("node_id"),
            G.text(_strings(), n).alias("heading"),
            G.text(_strings(), G.next_of(F.col("later"), F.col("later_at"), n)).alias("next_text"),
        ),
    )
    return page.select("page_id", F.inline(rows))


def harvest_headings(parsed, source, site_root, url=None, dedup=True):
    """Each h3 is a record: text of the next paragraph or block, amount and
    deadline line from the container, next link."""

    def facts(n):
        def read(t):
            return F.struct(B.amount_rupee(t).alias("amount"), keyword_line(t).alias("deadline"))

        return let(G.raw_text(_strings(), n), read)

    found = parsed.select(
        "page_id", "url", "nodes", "strings",
        G.tagged(_nodes(), "h3").alias("found"),
        G.tagged(_nodes(), "p", "div").alias("blocks"),
        G.links(_nodes()).alias("links"),
    )
    found = _with_parent_facts(found, facts)
    found = found.withColumns({"blocks_at": G.next_at(F.col("blocks")), "links_at": G.next_at(F.col("links"))})
    rows = F.transform(
        F.col("found"),
        lambda n: F.struct(
            n["id"].alias("node_id"),
            _fact(n).alias("fact"),
            G.text(_strings(), n).alias("title"),
            G.text(_strings(), G.next_of(F.col("blocks"), F.col("blocks_at"), n)).alias("next_text"),
            G.next_of(F.col("links"), F.col("links_at"), n)["attrs"]["href"].alias("href"),
        ),
    )
    records = found.select("page_id", "url", F.inline(rows))
    next_text = F.col("next_text")
    out = _listing(
        records.where(F.col("title") != ""),
        source,
        url,
        name=F.col("title"),
        description=F.when(F.length(next_text) > 10, truncate(next_text, 500)).otherwise(F.lit("")),
        funding_amount=F.col("fact.amount"),
        deadline=F.col("fact.deadline"),
        application_url=resolve_url(F.col("href"), site_root),
    )
    return keep_first_in_feed(out, PLACE) if dedup else out


def harvest_cascade(parsed, source, url=None, dedup=True):
    """List items that look like listings; where a page has none, paragraphs;
    where it has none of these either, headings with the paragraph after them."""
    content = F.col("content")
    page = G.once(parsed.select("page_id", "url", "nodes", "strings", G.main_content(_nodes(), CASCADE_CONTENT).alias("content"),
                                G.tagged(_nodes(), "p").alias("paragraphs")))
    page = page.withColumn("paragraphs_at", G.next_at(F.col("paragraphs")))

    def picked(tags, test, next_paragraph=False):
        def record(n):
            paragraph = G.next_of(F.col("paragraphs"), F.col("paragraphs_at"), n)
            after = G.text(_strings(), paragraph) if next_paragraph else F.lit("")
            return F.struct(
                n["id"].alias("node_id"),
                G.text(_strings(), n).alias("text"),
                F.coalesce(after, F.lit("")).alias("next_text"),
            )

        found = F.transform(G.tagged(G.inside(_nodes(), content), *tags), record)
        return F.filter(found, lambda r: test(r["text"]))

    def or_else(found, other):
        """Each is worked out once at most, and the other only where nothing was found."""
        return let(found, lambda x: F.when(F.size(x) > 0, x).otherwise(other))

    headings = picked(("h2", "h3", "h4", "h5"), is_heading_candidate, next_paragraph=True)
    items = or_else(picked(("li",), is_item_candidate), or_else(picked(("p",), is_paragraph_candidate), headings))
    records = page.select("page_id", "url", F.inline(items))
    out = _listing(
        records,
        source,
        url,
        name=truncate(F.col("text"), 200),
        description=truncate(F.col("next_text"), 500),
        funding_amount=B.amount_mixed(F.col("text")),
        deadline=B.date_text(F.col("text")),
    )
    return keep_first_in_feed(out, PLACE) if dedup else out


def article_links(parsed):
    """First link of each article, each address once over all pages."""
    rows = F.transform(
        G.tagged(_nodes(), "article"),
        lambda n: F.struct(
            n["id"].alias("node_id"), G.first(G.links(G.inside(_nodes(), n)))["attrs"]["href"].alias("link")
        ),
    )
    return first_seen_links(parsed.select("page_id", F.inline(rows)).where(F.col("link") != ""), PLACE)


def follow_links(pages, links):
    """Pages behind the links that listing pages gave, unparsed, each once.

    The links are staged, so that the planner knows their size: few are
    broadcast, of many a Bloom filter goes to the scan of the pages, and either
    way the html of no other page is moved.
    """
    wanted = stage_table(links.select(F.col("link").alias("url")).distinct(), "links")
    return pages.join(wanted, "url", "left_semi").select(*pages.columns)


def page_title(parsed):
    """Classed h1, else any h1."""
    title = G.text(_strings(), G.main_content(_nodes(), ARTICLE_TITLE))
    return G.rows_where(parsed.select("page_id", title.alias("title")), lambda r: r["title"].isNotNull())


def lead_paragraphs_of(content):
    """First two paragraphs, 300 characters; no paragraph gives an empty text."""
    lead = F.slice(G.tagged(G.inside(_nodes(), content), "p"), 1, 2)
    texts = F.transform(lead, lambda p: G.text(_strings(), p))
    return F.coalesce(truncate(F.array_join(texts, " "), 300), F.lit(""))


def lead_paragraphs(parsed):
    page = parsed.withColumn("content", G.main_content(_nodes(), ARTICLE_CONTENT))
    leads = page.select("page_id", F.when(F.col("content").isNotNull(), lead_paragraphs_of(F.col("content"))).alias("lead"))
    return G.rows_where(leads, lambda r: r["lead"].isNotNull())


def with_eligibility(page):
    """Add ``eligibility`` to pages that have ``content`` and ``full_text``.

    The section starts at the first fitting heading and reaches over the next
    15 elements of the document.
    """
    content = F.col("content")
    headings = F.filter(
        G.tagged(G.inside(_nodes(), content), *ELIGIBILITY_HEADINGS),
        lambda n: has_any(F.lower(G.text(_strings(), n)), P.ELIGIBILITY_HEADING_WORDS),
    )
    page = page.withColumn("anchor", G.first(headings))
    window = G.reach(_nodes(), F.col("anchor"), ELIGIBILITY_REACH)
    page = page.withColumn(
        "section",
        F.transform(
            window,
            lambda n: F.struct(
                n["id"].alias("id"), n["last"].alias("last"), n["tag"].alias("tag"),
                G.text(_strings(), n).alias("text"),
            ),
        ),
    )

    def last_with(words):
        hits = F.filter(F.col("section"), lambda s: has_any(F.lower(s["text"]), words))
        return F.try_element_at(hits, F.lit(-1))["text"]

    def list_texts(n):
        return F.transform(G.tagged(G.inside(_nodes(), n), "li"), lambda m: G.text(_strings(), m))

    def criteria_of(s):
        items = F.transform(F.filter(list_texts(s), lambda t: F.length(t) > 5), bullet)
        point = F.when((s["tag"] == "p") & is_bullet(s["text"]), F.array(s["text"]))
        return (
            F.when(s["tag"].isin("li", "ul", "ol"), items)
            .otherwise(F.coalesce(point, F.array().cast("array<string>")))
        )

    criteria = F.slice(F.flatten(F.transform(F.col("section"), criteria_of)), 1, 10)
    page = page.withColumns(
        {"countries": last_with(("eligible countries",)), "subjects": last_with(P.SUBJECT_WORDS), "criteria": criteria}
    )
    titled = F.when(F.size("criteria") > 0, F.concat(F.array(F.lit("Eligibility Criteria:")), F.col("criteria")))
    empty = F.array().cast("array<string>")
    found = F.concat(
        F.coalesce(F.array_compact(F.array("countries", "subjects")), empty), F.coalesce(titled, empty)
    )
    items = F.flatten(F.transform(G.tagged(G.inside(_nodes(), content), "ul"), list_texts))
    mention = F.when(F.col("full_text").contains("Sri Lanka"), F.array(F.lit("* Eligible Countries: Sri Lanka")))
    guessed = F.concat(F.coalesce(mention, empty), F.transform(F.filter(items, is_requirement_item), bullet))
    page = page.withColumn("found", found)
    page = page.withColumn("lines", F.when(F.size("found") > 0, F.col("found")).otherwise(guessed))
    joined = F.array_join(F.slice(F.col("lines"), 1, 15), "\n")
    return page.withColumn("eligibility", F.when(F.length(joined) > 10, joined).otherwise(F.lit(NA)))


def _article_pages(parsed):
    page = parsed.withColumn("content", G.main_content(_nodes(), ARTICLE_CONTENT))
    return page.withColumn("full_text", G.raw_text(_strings(), F.col("content")))


def eligibility_section(parsed):
    page = with_eligibility(_article_pages(parsed))
    found = F.when(F.col("content").isNotNull(), F.col("eligibility"))
    return G.rows_where(page.select("page_id", found.alias("eligibility")), lambda r: r["eligibility"].isNotNull())


def harvest_articles(parsed, source, url=None):
    """One record per titled page. Repeats are kept."""
    page = _article_pages(parsed).withColumn("title_node", G.main_content(_nodes(), ARTICLE_TITLE))
    page = page.withColumn("name", G.text(_strings(), F.col("title_node")))
    page = with_eligibility(page)
    full = F.coalesce(F.col("full_text"), F.lit(""))
    out = _listing(
        page.withColumn("node_id", F.col("title_node.id")),
        source,
        url,
        name=F.col("name"),
        description=lead_paragraphs_of(F.col("content")),
        eligibility=F.col("eligibility"),
        funding_amount=B.article_funding(full),
        deadline=B.article_deadline(full),
        contact=B.article_contact(full),
        application_url=F.col("url"),
    )
    return G.rows_where(out, lambda r: is_valid_name(r["name"]))


def harvest_entries(parsed, source, base_url, contact, country, languages, url=None):
    """One record per database entry: an h3 whose first link leads to a detail
    page; all fields come from the container around it. Repeats are kept."""

    def facts(n):
        def fields(t):
            status, subject = labelled_field(t, "Status:"), labelled_field(t, "Subject area:")
            return F.struct(
                status.alias("status"),
                subject.alias("subject"),
                labelled_field(t, "Application deadline:").alias("deadline"),
                B.entry_duration(t).alias("duration"),
                B.entry_funding(t).alias("funding"),
            )

        paragraph = G.text(_strings(), G.first(G.tagged(G.inside(_nodes(), n), "p")))
        block = G.first(F.filter(G.text_blocks(_strings(), n), lambda t: F.length(t) > 50))
        description = truncate(F.coalesce(paragraph, block, F.lit(NA)), 500)
        return F.struct(
            let(G.piped_text(_strings(), n), fields).alias("fields"),
            description.alias("description"),
        )

    titles = F.transform(
        G.tagged(_nodes(), "h3"),
        lambda n: F.struct(
            n["id"].alias("id"), n["parent"].alias("parent"),
            G.first(G.tagged(G.inside(_nodes(), n), "a")).alias("a"),
        ),
    )
    found = parsed.select(
        "page_id", "url", "nodes", "strings",
        F.filter(titles, lambda t: has_link_prefix(t["a"]["attrs"]["href"])).alias("found"),
    )
    found = _with_parent_facts(found, facts)
    rows = F.transform(
        F.col("found"),
        lambda t: F.struct(
            t["id"].alias("node_id"), _fact(t).alias("fact"),
            G.text(_strings(), t["a"]).alias("title"), t["a"]["attrs"]["href"].alias("href"),
        ),
    )
    records = found.select("page_id", "url", F.inline(rows)).select("*", "fact.fields.*")
    status, subject = F.col("status"), F.col("subject")
    return _listing(
        records,
        source,
        url,
        extras=ENTRY_EXTRAS,
        name=F.col("title"),
        description=F.col("fact.description"),
        eligibility=join_lines(
            F.when(status != NA, bullet(F.concat(F.lit("Status: "), status))),
            F.when(subject != NA, bullet(F.concat(F.lit("Subject: "), subject))),
        ),
        funding_amount=F.col("funding"),
        deadline=F.col("deadline"),
        contact=F.lit(contact),
        application_url=F.concat(F.lit(base_url), F.col("href")),
        status=status,
        subject_area=subject,
        study_level=F.when(status == NA, F.lit(NA)).otherwise(study_level(status)),
        program_type=program_type(F.col("title")),
        duration=F.col("duration"),
        target_group=status,
        country=F.lit(country),
        language_requirements=F.lit(languages),
    )
