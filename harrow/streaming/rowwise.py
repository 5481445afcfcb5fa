"""The row-wise part of the clean chains over a stream of listings.

Keep-first needs the whole table and stays a batch step; all other stages work
row by row and run on a stream as they are. The stream carries no state.
"""

from harrow.operators import conform, filters
from harrow.plans import clean


def clean_loan_rows(stream):
    """Conform, clean, score and classify loan rows as they arrive."""
    rows = clean.clean_loan_cells(conform.conform_loans(conform.map_null_tokens(stream)))
    return conform.reorder_loans(filters.named(rows))


def clean_scholarship_rows(stream):
    rows = clean.clean_scholarship_cells(conform.conform_scholarships(conform.map_null_tokens(stream)))
    return conform.reorder_scholarships(filters.named_and_sourced(rows))
