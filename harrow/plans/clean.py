"""The two clean chains.

Each is one lazy chain with one shuffle, the keep-first by name. Rows are
deduplicated before their text is cleaned, so names that differ in white space
only both stay, and the extractors run on kept rows alone.
"""

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.functions import classify, extract, score, text
from harrow.functions.text import not_na_literal
from harrow.operators import conform, dedup, report
from harrow.session import stage_table

COPIES = "_copies"
_LOAN_TEXT = ("name", "description", "eligibility", "contact", "loan_product_name")
_SCHOLARSHIP_TEXT = ("name", "description", "eligibility", "contact")


@dataclass(frozen=True)
class Clean:
    """A clean chain. Each part is planned when it is asked for."""

    scored: DataFrame
    keep: Callable
    reorder: Callable
    breakdowns: tuple
    fields: tuple
    order: tuple

    def table(self, keep_order=False):
        """The cleaned rows in canonical column order."""
        dropped = (COPIES,) if keep_order else (COPIES, *self.order)
        return self.reorder(self.scored.where(self.keep()).drop(*dropped))

    def report(self):
        """Quality figures as ``(section, metric, value)``."""
        return report.quality_report(self.scored, self.keep(), self.breakdowns, self.fields, COPIES)

    def stages(self):
        """Rows loaded, dropped and kept."""
        return report.stage_counts(self.scored, self.keep(), COPIES)

    def staged(self, name):
        """The same chain over its scored rows written to a staged table."""
        return replace(self, scored=stage_table(self.scored, name))


def clean_loan_cells(df):
    """Row-wise part of the loan chain up to score and classes."""
    out = df.withColumns({c: text.clean_text(F.col(c)) for c in _LOAN_TEXT})
    amounts = ("funding_amount", "maximum_loan_amount", "minimum_loan_amount")
    out = out.withColumns({c: extract.amount(F.col(c)) for c in amounts})
    out = out.withColumns(
        {
            "repayment_period": extract.period(F.col("repayment_period")),
            "interest_rate": extract.rate(F.col("interest_rate")),
            "age_criteria": extract.age(F.col("age_criteria")),
            "eligibility": text.clean_eligibility(F.col("eligibility")),
            "_rules": text.rule_text(F.col("name"), F.col("description")),
        }
    )
    return out.withColumns(
        {
            "data_quality_score": score.quality_score(score.LOAN_FIELDS),
            "loan_type": classify.loan_type(F.col("_rules")),
            "loan_duration_category": classify.duration_bucket(F.col("repayment_period")),
        }
    ).drop("_rules")


def clean_scholarship_cells(df):
    """Row-wise part of the scholarship chain up to score and classes."""
    out = df.withColumns({c: text.clean_text(F.col(c)) for c in _SCHOLARSHIP_TEXT})
    out = out.withColumns(
        {
            "funding_amount": extract.funding(F.col("funding_amount")),
            "deadline": extract.deadline(F.col("deadline")),
            "eligibility": text.clean_eligibility(F.col("eligibility")),
        }
    )
    out = out.withColumns(
        {
            "_rules": text.rule_text(F.col("name"), F.col("description")),
            "_region": text.rule_text(F.col("name"), F.col("description"), F.col("eligibility")),
        }
    )
    return out.withColumns(
        {
            "data_quality_score": score.quality_score(score.SCHOLARSHIP_FIELDS),
            "scholarship_type": classify.scholarship_type(F.col("_rules")),
            "eligible_region": classify.eligible_region(F.col("_region")),
        }
    ).drop("_rules", "_region")


def loans_kept():
    return not_na_literal(F.col("name"))


def scholarships_kept():
    return not_na_literal(F.col("name")) & not_na_literal(F.col("source"))


def clean_loans(raw, order, alias_fallback=False, staged=False):
    """Clean loaded loan feeds (null tokens already NULL).

    ``order`` names the columns that give the load order. ``staged``: the rows
    are read from staged tables, so they may be read twice.
    """
    kept = dedup.keep_first_by_name(conform.conform_loans(raw, alias_fallback), order, copies=COPIES, staged=staged)
    return Clean(clean_loan_cells(kept), loans_kept, conform.reorder_loans,
                 report.LOAN_BREAKDOWNS, report.LOAN_COMPLETENESS, tuple(order))


def clean_scholarships(raw, order, staged=False):
    """Clean loaded scholarship feeds (null tokens already NULL)."""
    kept = dedup.keep_first_by_name(conform.conform_scholarships(raw, keep=order), order, copies=COPIES, staged=staged)
    return Clean(clean_scholarship_cells(kept), scholarships_kept, conform.reorder_scholarships,
                 report.SCHOLARSHIP_BREAKDOWNS, report.SCHOLARSHIP_COMPLETENESS, tuple(order))
