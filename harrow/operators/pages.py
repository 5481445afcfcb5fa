"""Pages as node trees, and the steps that walk them.

``parse_pages`` turns each page into one row:

* ``nodes``    elements in document order; ``nodes[id]`` has its own position as
  ``id``, its parent, and ``last``, the id of its last descendant, so "inside n"
  is the span ``id+1 .. last``. Node 0 is the document.
* ``strings``  text strings in document order; node n covers ``strings[p0:p1]``,
  so no text is stored twice. ``owners`` names the node each string sits in.

A page never leaves its row: finding, walking and reading text are array
expressions on that row, with no join, window or shuffle.
"""

from pyspark.sql import functions as F

from harrow.functions.text import let, strip
from harrow.operators.page_tree import NODES_TYPE, PARSED_SCHEMA, parse_batches


def parse_pages(pages):
    """One node tree per page. The only Python in the engine; filter pages
    before this step, nothing is pushed through it."""
    source = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return source.mapInArrow(parse_batches, PARSED_SCHEMA)


# --- walking: column expressions over one page's nodes and strings ----------


def _span(array, low, high, kind):
    """Elements ``low .. high-1`` by position. Costs the span alone, where
    ``slice`` would unpack the whole array on each call. NULL bounds give NULL."""
    picked = F.transform(F.sequence(low, high - 1), lambda i: F.get(array, i))
    return F.when(high > low, picked).when(high <= low, F.array().cast(kind))


def inside(nodes, n):
    """Descendants of a node, document order."""
    return _span(nodes, n["id"] + 1, n["last"] + 1, NODES_TYPE)


def reach(nodes, n, count):
    """The next ``count`` nodes after a node's start tag."""
    return _span(nodes, n["id"] + 1, F.least(n["id"] + 1 + count, F.size(nodes)), NODES_TYPE)


def next_at(candidates):
    """For each node, by its id, the position of the first candidate after its start tag, its own descendants included.

    Built in one pass: each candidate stands for the nodes since the one before.
    ``candidates`` must be a column that is worked out already (``once``).
    """
    def reached(c, k):
        before = F.coalesce(F.get(candidates, k - 1)["id"], F.lit(0))
        return F.array_repeat(k, c["id"] - before)

    return F.flatten(F.transform(candidates, reached))


def next_of(candidates, at, n):
    """The first of the page's candidates after a node; ``at`` is their ``next_at``, worked out already."""
    return F.get(candidates, F.get(at, n["id"]))


def position_at(ids):
    """For each number up to the last of some sorted, different ids: the position of the first id that is not below it."""
    return F.flatten(F.transform(ids, lambda i, k: F.array_repeat(k, i - F.coalesce(F.get(ids, k - 1), F.lit(-1)))))


def once(df):
    """The frame with its columns worked out. What follows reads them and is not merged with what they are made of,
    which would work them out once for each use, in a lambda for each element."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def has_tag(*tags):
    return lambda m: m["tag"].isin(*tags)


def tagged(nodes, *tags):
    return F.filter(nodes, has_tag(*tags))


def is_link(m):
    """An anchor that carries an href."""
    return (m["tag"] == "a") & m["attrs"]["href"].isNotNull()


def links(nodes):
    return F.filter(nodes, is_link)


def classed(nodes, tag, classes):
    """Nodes of one tag that have any of the classes."""
    wanted = F.array(*[F.lit(c) for c in classes])

    def hit(m):
        own = F.split(F.coalesce(m["attrs"]["class"], F.lit("")), r"\s+")
        return (m["tag"] == tag) & F.arrays_overlap(own, wanted)

    return F.filter(nodes, hit)


def first(array):
    return F.get(array, F.lit(0))


def node_at(nodes, node_id):
    return F.get(nodes, node_id)


def _strings(strings, n):
    return _span(strings, n["p0"], n["p1"], "array<string>")


def raw_text(strings, node):
    return let(node, lambda n: F.array_join(_strings(strings, n), ""))


def text_blocks(strings, node):
    """Non-empty stripped strings of a node."""
    return let(node, lambda n: F.filter(F.transform(_strings(strings, n), strip), lambda t: t != ""))


def text(strings, node):
    """Stripped strings, joined without a separator."""
    return let(node, lambda n: F.array_join(F.transform(_strings(strings, n), strip), ""))


def piped_text(strings, node):
    return F.array_join(text_blocks(strings, node), " | ")


def rows_where(df, test):
    """Rows whose computed columns pass a test.

    A plain filter would be pushed below the projection and its expressions,
    heavy array walks here, be worked out once more for it.
    """
    return df.select(F.inline(F.filter(F.array(F.struct(*df.columns)), test)))


# --- relational views --------------------------------------------------------


def page_nodes(parsed):
    """One row per element. Strings are stripped once for a page, not for each element around them."""
    strings, owners = F.col("strings"), F.col("owners")
    page = once(parsed.select("page_id", "nodes", "strings", "owners", F.transform("strings", strip).alias("stripped")))

    def row(n):
        own = F.filter(F.sequence(n["p0"], n["p1"]), lambda i: (i < n["p1"]) & (F.get(owners, i) == n["id"]))
        return F.struct(
            n["id"].alias("node_id"),
            n["parent"].alias("parent_id"),
            n["last"].alias("end_id"),
            n["depth"].alias("depth"),
            n["tag"].alias("tag"),
            n["attrs"].alias("attrs"),
            F.array_join(F.transform(own, lambda i: F.get(strings, i)), "").alias("own_text"),
            F.array_join(_strings(F.col("stripped"), n), "").alias("text"),
        )

    return page.select("page_id", F.inline(F.transform("nodes", row)))


def find_all(parsed, *tags):
    """Nodes with one of the tags, with their stripped text."""
    hits = F.transform(
        tagged(F.col("nodes"), *tags),
        lambda n: F.struct(
            n["id"].alias("node_id"), n["tag"].alias("tag"), text(F.col("strings"), n).alias("text")
        ),
    )
    return parsed.select("page_id", F.inline(hits))


def node_counts(parsed, tags):
    """Elements per page for each tag."""
    return parsed.select(
        "page_id", *[F.size(tagged(F.col("nodes"), t)).cast("long").alias(f"n_{t}") for t in tags]
    )


def main_content(nodes, chain):
    """First node by a fallback chain of ``(tag, classes or None)``."""
    tries = [first(classed(nodes, tag, classes) if classes else tagged(nodes, tag)) for tag, classes in chain]
    return F.coalesce(*tries)
