"""Ordered keyword classes, buckets and bands."""

import sys
import unicodedata

from pyspark.sql import functions as F

from harrow.functions import patterns as P
from harrow.functions.text import holds, let
from harrow.schema import NA


def keyword_class(lower_text, rules, default):
    """Label of the first rule with a word in the text."""

    def pick(t):
        chain = F
        for words, label in rules:
            chain = chain.when(holds(t, words), F.lit(label))
        return chain.otherwise(F.lit(default))

    return let(lower_text, pick)


def loan_type(rule_text):
    return keyword_class(rule_text, P.LOAN_TYPE, "Other")


def scholarship_type(rule_text):
    return keyword_class(rule_text, P.SCHOLARSHIP_TYPE, "General")


def eligible_region(rule_text):
    return keyword_class(rule_text, P.ELIGIBLE_REGION, "Unknown")


def study_level(status):
    return keyword_class(F.lower(status), P.STUDY_LEVEL, NA)


def program_type(title):
    return keyword_class(F.lower(title), P.PROGRAM_TYPE, NA)


def _digits():
    """Decimal digits of all scripts, and the ASCII ones that they stand for."""
    known = [(chr(c), unicodedata.decimal(chr(c), None)) for c in range(128, sys.maxunicode + 1)]
    known = [(c, str(d)) for c, d in known if d is not None]
    return "".join(c for c, _ in known), "".join(d for _, d in known)


_DIGITS = _digits()


def duration_bucket(period):
    """Bucket by the first number in the period, whatever its unit."""
    digits = F.regexp_extract(F.coalesce(period, F.lit("")), P.java(r"\d+"), 0)
    number = F.translate(digits, *_DIGITS).try_cast("decimal(38,0)")
    return (
        F.when(digits == "", F.lit("Unknown"))
        .when(number <= 3, F.lit("Short-term (≤3 years)"))
        .when(number <= 7, F.lit("Medium-term (4-7 years)"))
        .otherwise(F.lit("Long-term (>7 years)"))
    )


def quality_band(score):
    return (
        F.when(score >= 80, F.lit("Excellent"))
        .when(score >= 60, F.lit("Good"))
        .when(score >= 40, F.lit("Average"))
        .when(score < 40, F.lit("Poor"))
    )
