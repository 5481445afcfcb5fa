"""Bring a frame to the canonical columns."""

from pyspark.sql import functions as F

from harrow.functions.text import null_tokens
from harrow.schema import BANK, COMMON, LOAN_ORDER, NA, SCHOLARSHIP_ORDER

# fallback column -> canonical column it may fill
_ALIASES = (
    ("bank_name", "name"),
    ("loan_product_name", "name"),
    ("contact_info", "contact"),
    ("website_url", "application_url"),
)


def map_null_tokens(df, keep=()):
    """Every string cell that spells "no value" becomes NULL."""

    def cell(name, kind):
        return null_tokens(name).alias(name) if kind == "string" and name not in keep else f"`{name}`"

    return df.select(*[cell(c, t) for c, t in df.dtypes])


def add_missing(df, columns):
    """Add absent columns as the literal N/A (not NULL)."""
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(NA) for c in absent}) if absent else df


def conform_loans(df, alias_fallback=False):
    """Add absent common and bank columns, keep all others.

    ``alias_fallback`` fills an unnamed row from its bank columns (name, contact,
    link). It is off by default: unnamed bank products then collapse to one row.
    """
    out = add_missing(df, COMMON + BANK)
    if alias_fallback:
        for alias, target in _ALIASES:
            filled = F.coalesce(F.nullif(F.col(target), F.lit(NA)), F.nullif(F.col(alias), F.lit(NA)), F.lit(NA))
            out = out.withColumn(target, filled)
    return out


def name_from_product(df):
    """Use the product name where a loaded name column holds no name at all.

    The test stops at the first name it meets.
    """
    if {"name", "loan_product_name"} <= set(df.columns) and df.where(F.col("name").isNotNull()).isEmpty():
        return df.withColumn("name", F.col("loan_product_name"))
    return df


def conform_scholarships(df, keep=()):
    """Add absent common columns and drop all others (but for ``keep``)."""
    return add_missing(df, COMMON).select(*COMMON, *keep)


def _reorder(df, order):
    first = [c for c in order if c in df.columns]
    return df.select(*first, *sorted(set(df.columns) - set(first)))


def reorder_loans(df):
    """Canonical columns first, the rest by name."""
    return _reorder(df, LOAN_ORDER)


def reorder_scholarships(df):
    return _reorder(df, SCHOLARSHIP_ORDER)
