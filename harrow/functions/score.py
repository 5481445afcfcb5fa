"""Completeness score of a row."""

from functools import reduce
from operator import add

from pyspark.sql import functions as F

from harrow.functions.text import is_na

# --- fixed values -----------------------------------------------------------
LOAN_FIELDS = ("name", "description", "eligibility", "funding_amount", "contact")
SCHOLARSHIP_FIELDS = ("name", "description", "eligibility", "funding_amount", "deadline", "contact")
# ----------------------------------------------------------------------------


def quality_score(fields):
    """Share of filled fields in percent, two decimals; an empty string counts
    as filled, NULL and N/A do not."""
    filled = reduce(add, [F.when(is_na(F.col(f)), 0).otherwise(1) for f in fields])
    return F.round(filled * F.lit(100.0) / F.lit(float(len(fields))), 2)
