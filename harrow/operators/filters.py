"""Row gates."""

from pyspark.sql import functions as F

from harrow.functions import patterns as P
from harrow.functions.text import has_any, not_na_literal, strip
from harrow.schema import NA


def named(df):
    """Drop rows named N/A; a NULL name stays."""
    return df.where(not_na_literal(F.col("name")))


def named_and_sourced(df):
    return df.where(not_na_literal(F.col("name")) & not_na_literal(F.col("source")))


def is_valid_name(name):
    return name.isNotNull() & ~name.isin("", NA)


def valid_name(df):
    """Keep rows with a real, non-empty name."""
    return df.where(is_valid_name(F.col("name")))


def is_item_candidate(text):
    return (F.length(text) >= 10) & has_any(F.lower(text), P.ITEM_WORDS)


def is_paragraph_candidate(text):
    return (F.length(text) > 20) & has_any(F.lower(text), P.PARAGRAPH_WORDS)


def is_heading_candidate(text):
    return (F.length(text) > 10) & has_any(F.lower(text), P.HEADING_WORDS)


# block kind -> candidate test on its stripped text
_CANDIDATE = {
    "item": is_item_candidate,
    "paragraph": is_paragraph_candidate,
    "heading": is_heading_candidate,
}


def candidate_blocks(blocks, kind, text="text"):
    """Blocks of one kind whose text looks like a listing."""
    return blocks.where(_CANDIDATE[kind](strip(F.col(text))))


def has_link_prefix(href, prefix="?type=a"):
    return F.coalesce(href.startswith(prefix), F.lit(False))


def is_requirement_item(text):
    return has_any(F.lower(text), P.REQUIREMENT_WORDS) & (F.length(text) < 200)
