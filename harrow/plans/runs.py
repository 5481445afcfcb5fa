"""Folder to folder runs of the clean chains."""

from datetime import datetime, timezone

from harrow.operators import conform
from harrow.plans import clean
from harrow.session import stage_scope
from harrow.sources import feeds, sinks


def clean_loan_folder(spark, folder, out, stamp=None, exclude_outputs=False, alias_fallback=False):
    """Load the loan feeds of a folder, clean them, write table and report.

    Returns the path of the stable copy, or None where no feed could be read.
    """
    with stage_scope(spark):
        raw = feeds.load_loan_feeds(spark, folder, exclude_outputs)
        if raw is None:
            return None
        chain = clean.clean_loans(conform.name_from_product(raw), feeds.LOAD_ORDER, alias_fallback, staged=True)
        return _write(chain, out, "loans", stamp)


def clean_scholarship_folder(spark, folder, out, stamp=None, exclude_outputs=False):
    """Load the scholarship feeds of a folder, clean them, write table and report."""
    with stage_scope(spark):
        raw = feeds.load_scholarship_feeds(spark, folder, exclude_outputs)
        if raw is None:
            return None
        return _write(clean.clean_scholarships(raw, feeds.LOAD_ORDER, staged=True), out, "scholarships", stamp)


def _write(chain, out, name, stamp):
    """The scored rows are staged once; report and both copies read the stage."""
    stamp = stamp or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    chain = chain.staged(name)
    sinks.write_report(chain.report(), out, name, stamp)
    return sinks.write_cleaned(chain.table(), out, f"{name}_cleaned", stamp)
