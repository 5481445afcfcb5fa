"""Canonical columns, null tokens and output orders."""

from pyspark.sql import types as T

NA = "N/A"

# --- fixed values -----------------------------------------------------------
COMMON = (
    "name", "description", "eligibility", "funding_amount", "deadline",
    "contact", "application_url", "source", "url", "scrape_date",
)

BANK = (
    "bank_name", "loan_product_name", "maximum_loan_amount", "minimum_loan_amount",
    "interest_rate", "repayment_period", "age_criteria", "income_criteria",
    "documents_required", "special_benefits", "contact_info", "website_url", "bank_code",
)

ENTRY_EXTRAS = (
    "status", "subject_area", "study_level", "program_type", "duration",
    "target_group", "country", "language_requirements",
)

LOAN_ORDER = (
    "name", "loan_type", "loan_duration_category", "description", "eligibility",
    "maximum_loan_amount", "minimum_loan_amount", "funding_amount", "interest_rate",
    "repayment_period", "age_criteria", "income_criteria", "contact",
    "application_url", "source", "data_quality_score", "scrape_date",
)

SCHOLARSHIP_ORDER = (
    "name", "scholarship_type", "eligible_region", "description", "eligibility",
    "funding_amount", "deadline", "contact", "application_url", "source", "url",
    "data_quality_score", "scrape_date",
)

# cell texts that a feed file uses for "no value"
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# whole cell values that the text cleaner folds into NA
NULL_LIKE = ("N/A", "n/a", "NA", "None", "none", "")
# ----------------------------------------------------------------------------


def string_schema(columns):
    """All-string schema: every feed cell is text until a rule types it."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
