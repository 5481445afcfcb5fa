"""Field extractors of the clean chains: ordered rules, first hit wins.

Each maps NULL and N/A to N/A, and keeps the text where no rule hits.
"""

from pyspark.sql import functions as F

from harrow.functions import patterns as P
from harrow.functions.text import has_any, is_na, strip
from harrow.schema import NA


def _rules(c, hits, fallback):
    """CASE chain: N/A guard, then (condition, value) pairs, then fallback."""
    chain = F.when(is_na(c), F.lit(NA))
    for condition, value in hits:
        chain = chain.when(condition, value)
    return chain.otherwise(F.when(fallback == "", F.lit(NA)).otherwise(fallback))


def amount(c, words=P.LOAN_AMOUNT_WORDS):
    """``Rs. <digits>`` from the first currency form found; percentages and
    worded amounts are trimmed, other text stays as it is."""
    hits = []
    for pattern in P.AMOUNT:
        regex = P.java(pattern, ignore_case=True)
        digits = F.translate(F.regexp_extract(c, regex, 1), ",", "")
        hits.append((c.rlike(regex), F.concat(F.lit("Rs. "), digits)))
    hits.append((c.contains("%"), strip(c)))
    hits.append((has_any(F.lower(c), words), strip(c)))
    return _rules(c, hits, c)


def funding(c):
    return amount(c, P.FUNDING_AMOUNT_WORDS)


def period(c):
    t = strip(c)
    hits = []
    for pattern, unit in P.PERIOD:
        regex = P.java(pattern, ignore_case=True)
        hits.append((t.rlike(regex), F.concat(F.regexp_extract(t, regex, 1), F.lit(" " + unit))))
    return _rules(c, hits, t)


def rate(c):
    t = strip(c)
    regex = P.java(P.RATE)
    hits = [
        (t.rlike(regex), F.concat(F.regexp_extract(t, regex, 1), F.lit("%"))),
        (has_any(F.lower(t), P.FREE_RATE_WORDS), F.lit("Interest-Free")),
    ]
    return _rules(c, hits, t)


def age(c):
    t = strip(c)
    span = P.java(P.AGE_RANGE)
    single = P.java(P.AGE_SINGLE, ignore_case=True)
    low, high = F.regexp_extract(t, span, 1), F.regexp_extract(t, span, 2)
    hits = [
        (t.rlike(span), F.concat(low, F.lit("-"), high, F.lit(" years"))),
        (t.rlike(single), F.concat(F.regexp_extract(t, single, 1), F.lit("+ years"))),
    ]
    return _rules(c, hits, t)


def deadline(c):
    t = strip(c)
    hits = []
    for pattern in P.DEADLINE:
        regex = P.java(pattern, ignore_case=True)
        hits.append((t.rlike(regex), F.regexp_extract(t, regex, 1)))
    hits.append((has_any(F.lower(t), P.TIME_SPAN_WORDS), t))
    hits.append((has_any(F.lower(t), P.ONGOING_WORDS), F.lit("Ongoing")))
    return _rules(c, hits, t)
