"""Checks over text blocks."""

from pyspark.sql import functions as F

from harrow.checks.fixtures import RAW_BLOCKS, derived, table
from harrow.checks.listings import check
from harrow.functions import blocks, classify, text
from harrow.operators import filters

_RAW = f"raw AS ({RAW_BLOCKS})"
_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
_WS = "' ' || chr(9) || chr(10) || chr(13)"


def _block_check(key, sql, expression):
    @check(key, f"WITH {_RAW} SELECT block_id, {sql} AS value FROM raw")
    def _(spark, sf):
        return derived(spark, sf, RAW_BLOCKS).select("block_id", expression(F.col("text")).alias("value"))


def _whole(patterns, flags=""):
    cases = "".join(
        f" WHEN regexp_matches(text, '{p}', '{flags}') THEN regexp_extract(text, '{p}', 0, '{flags}')" for p in patterns
    )
    return f"CASE{cases} ELSE 'N/A' END"


_NUMBER = "([0-9]{1,3}(?:,[0-9]{3})*(?:\\.[0-9]{2})?)"
_DEADLINES = (
    "(?:deadline|closing\\s+date|application\\s+deadline)[:\\s]+([^\\n]+?)(?:\\n|$)",
    "(?:Deadline|Closing Date)[:\\s]+([^\\n]+)",
    "(\\d{1,2}[-/]\\d{1,2}[-/]\\d{2,4})",
    f"(\\d{{1,2}}\\s+(?:{_MONTHS})\\s+\\d{{4}})",
)


def _deadline_sql():
    tries = []
    for p in _DEADLINES:
        value = f"trim(replace(replace(regexp_extract(text, '{p}', 1, 'i'), chr(10), ' '), chr(13), ''), {_WS})"
        tries.append(f"CASE WHEN length({value}) BETWEEN 1 AND 99 THEN {value} END")
    return f"coalesce({', '.join(tries)}, 'N/A')"


_block_check("feed_amount_a", _whole(["(Rs\\.|LKR)\\s*([\\d,]+)"]), blocks.amount_rupee)
_block_check("feed_amount_b", _whole(["(Rs\\.|LKR|USD|\\$)\\s*([\\d,]+)"]), blocks.amount_mixed)
_block_check(
    "feed_deadline_b",
    _whole(["\\d{1,2}[/-]\\d{1,2}[/-]\\d{2,4}", f"\\d{{1,2}}\\s+({_MONTHS})\\s+\\d{{4}}"]),
    blocks.date_text,
)
_block_check(
    "feed_funding_c",
    _whole(
        [
            "(?:award|amount|fund|scholarship|grant)[:\\s]*(?:\\$|USD|Rs\\.?|LKR)?\\s*" + _NUMBER,
            "(?:\\$|USD|Rs\\.?|LKR)\\s*" + _NUMBER,
            _NUMBER + "\\s*(?:\\$|USD|Rs\\.?|LKR)",
        ],
        "i",
    ),
    blocks.article_funding,
)
_block_check("feed_deadline_c", _deadline_sql(), blocks.article_deadline)
_CONTACT = "(?:contact|email)[:\\s]+([^\\n]+)"
_block_check(
    "feed_contact",
    f"CASE WHEN regexp_matches(text, '{_CONTACT}', 'i') THEN substr(regexp_extract(text, '{_CONTACT}', 1, 'i'), 1, 100)"
    " ELSE 'N/A' END",
    blocks.article_contact,
)
_block_check(
    "feed_duration",
    _whole(["(\\d+)\\s*(?:month|months|mo)", "(\\d+)\\s*(?:year|years|yr)"], "i"),
    blocks.entry_duration,
)
_EURO = "€\\s*([0-9,]+)"
_block_check(
    "feed_funding_d",
    f"CASE WHEN contains(text, '€') OR contains(text, 'EUR') THEN CASE WHEN regexp_matches(text, '{_EURO}')"
    f" THEN '€' || regexp_extract(text, '{_EURO}', 1) || ' per month' ELSE 'N/A' END"
    " WHEN regexp_matches(lower(text), 'monthly allowance|stipend') THEN 'Monthly stipend provided'"
    " WHEN contains(lower(text), 'fully funded') THEN 'Fully funded' ELSE 'N/A' END",
    blocks.entry_funding,
)
_block_check(
    "keyword_line",
    "coalesce(substr(trim(list_filter(string_split(text, chr(10)),"
    f" lambda x: contains(lower(x), 'deadline') OR contains(lower(x), 'closing'))[1], {_WS}), 1, 100), 'N/A')",
    text.keyword_line,
)


def _label_sql(label):
    return (
        f"CASE WHEN contains(text, '{label}') THEN trim(split_part(split_part(text, '{label}', 2), '|', 1), {_WS})"
        " ELSE 'N/A' END"
    )


_LABELS = (("status", "Status:"), ("subject", "Subject area:"), ("deadline", "Application deadline:"))


@check(
    "labelled_field",
    f"WITH {_RAW} SELECT block_id, " + ", ".join(f"{_label_sql(label)} AS {name}" for name, label in _LABELS) + " FROM raw",
)
def _(spark, sf):
    return derived(spark, sf, RAW_BLOCKS).select(
        "block_id", *[text.labelled_field(F.col("text"), label).alias(name) for name, label in _LABELS]
    )


@check(
    "join_lines",
    f"WITH {_RAW}, f AS (SELECT block_id, {_label_sql('Status:')} AS s, {_label_sql('Subject area:')} AS a FROM raw)"
    " SELECT block_id, CASE WHEN s = 'N/A' AND a = 'N/A' THEN 'N/A' ELSE array_to_string(list_filter("
    "[CASE WHEN s <> 'N/A' THEN '• Status: ' || s END, CASE WHEN a <> 'N/A' THEN '• Subject: ' || a END],"
    " lambda x: x IS NOT NULL), chr(10)) END AS value FROM f",
)
def _(spark, sf):
    status = text.labelled_field(F.col("text"), "Status:")
    subject = text.labelled_field(F.col("text"), "Subject area:")
    lines = text.join_lines(
        F.when(status != "N/A", text.bullet(F.concat(F.lit("Status: "), status))),
        F.when(subject != "N/A", text.bullet(F.concat(F.lit("Subject: "), subject))),
    )
    return derived(spark, sf, RAW_BLOCKS).select("block_id", lines.alias("value"))


@check(
    "study_level",
    f"WITH {_RAW}, f AS (SELECT block_id, lower({_label_sql('Status:')}) AS s FROM raw) SELECT block_id, CASE"
    " WHEN regexp_matches(s, 'doctoral|phd') THEN 'Doctoral/PhD' WHEN contains(s, 'master') THEN 'Master''s'"
    " WHEN contains(s, 'bachelor') THEN 'Bachelor''s' WHEN contains(s, 'graduate') THEN 'Graduate' ELSE 'N/A' END"
    " AS value FROM f",
)
def _(spark, sf):
    status = text.labelled_field(F.col("text"), "Status:")
    return derived(spark, sf, RAW_BLOCKS).select("block_id", classify.study_level(status).alias("value"))


_block_check(
    "program_type",
    "CASE WHEN contains(lower(text), 'research') THEN 'Research Grant'"
    " WHEN regexp_matches(lower(text), 'study|scholarship') THEN 'Study Scholarship'"
    " WHEN contains(lower(text), 'summer') THEN 'Summer Program' ELSE 'N/A' END",
    classify.program_type,
)

_CANDIDATES = (
    ("item", "length(trim(text)) >= 10", "scholarship|grant|award|fund|assistance|loan|bursary"),
    ("paragraph", "length(trim(text)) > 20", "scholarship|grant|award|fund|bursary"),
    ("heading", "length(trim(text)) > 10", "scholarship|grant|award|fund"),
)


@check(
    "candidate_blocks",
    f"WITH {_RAW} "
    + " UNION ALL ".join(
        f"SELECT block_id, '{kind}' AS kind FROM raw WHERE {size} AND regexp_matches(lower(text), '{words}')"
        for kind, size, words in _CANDIDATES
    ),
)
def _(spark, sf):
    raw = derived(spark, sf, RAW_BLOCKS)
    kinds = [filters.candidate_blocks(raw, k).select("block_id", F.lit(k).alias("kind")) for k, _, _ in _CANDIDATES]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


@check(
    "truncate",
    "SELECT doc_id, substr(text, 1, 100) AS t100, substr(text, 1, 200) AS t200, substr(text, 1, 300) AS t300,"
    " substr(text, 1, 500) AS t500 FROM documents",
)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", *[text.truncate(F.col("text"), n).alias(f"t{n}") for n in (100, 200, 300, 500)])
