"""Extractors over harvested text blocks; a miss gives N/A."""

from pyspark.sql import functions as F

from harrow.functions import patterns as P
from harrow.functions.text import has_any, one_line, only_if, truncate
from harrow.schema import NA


def _first_whole_match(c, regexes):
    chain = F
    for regex in regexes:
        chain = chain.when(c.rlike(regex), F.regexp_extract(c, regex, 0))
    return chain.otherwise(F.lit(NA))


def amount_rupee(c):
    """Whole ``Rs.``/``LKR`` amount."""
    return _first_whole_match(c, [P.java(P.BLOCK_AMOUNT_RUPEE)])


def amount_mixed(c):
    """Whole amount in rupees or dollars, case-sensitive."""
    return _first_whole_match(c, [P.java(P.BLOCK_AMOUNT_MIXED)])


def date_text(c):
    """First numeric date, else first date with a month name, case-sensitive."""
    return _first_whole_match(c, [P.java(p) for p in P.BLOCK_DATE])


def article_funding(c):
    """Whole funding phrase, label words included."""
    return _first_whole_match(c, [P.java(p, ignore_case=True) for p in P.ARTICLE_FUNDING])


def article_deadline(c):
    """First pattern whose value is 1 to 99 characters long."""
    values = []
    for pattern in P.ARTICLE_DEADLINE:
        value = one_line(F.regexp_extract(c, P.java(pattern, ignore_case=True), 1))
        values.append(only_if(value, lambda v: F.length(v).between(1, 99)))
    return F.coalesce(*values, F.lit(NA))


def article_contact(c):
    regex = P.java(P.ARTICLE_CONTACT, ignore_case=True)
    return F.when(c.rlike(regex), truncate(F.regexp_extract(c, regex, 1), 100)).otherwise(F.lit(NA))


def entry_duration(c):
    """Months win over years wherever they stand."""
    return _first_whole_match(c, [P.java(p, ignore_case=True) for p in P.ENTRY_DURATION])


def entry_funding(c):
    regex = P.java(P.ENTRY_EURO)
    low = F.lower(c)
    euro = F.when(
        c.rlike(regex), F.concat(F.lit("€"), F.regexp_extract(c, regex, 1), F.lit(" per month"))
    ).otherwise(F.lit(NA))
    return (
        F.when(c.contains("€") | c.contains("EUR"), euro)
        .when(has_any(low, ("monthly allowance", "stipend")), F.lit("Monthly stipend provided"))
        .when(low.contains("fully funded"), F.lit("Fully funded"))
        .otherwise(F.lit(NA))
    )
