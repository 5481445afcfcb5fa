"""Checks over listing rows: query and SQL side by side, keyed by operator."""

from pyspark.sql import functions as F

from harrow.checks.fixtures import RAW_LISTINGS, derived, table
from harrow.functions import classify, extract, score, text
from harrow.operators import conform, dedup, expand, filters, preview, report, union
from harrow.plans import clean, merge

QUERIES, ORACLES = {}, {}

ORDER = ("row_id",)
_CELLS = (
    "source", "name", "description", "eligibility", "funding_amount", "repayment_period", "interest_rate",
    "age_criteria", "deadline", "contact",
)


def check(key, sql=None):
    def register(query):
        QUERIES[key] = query
        if sql:
            ORACLES[key] = sql
        return query

    return register


def raw(spark, sf):
    """Raw listings as loaded from a feed file: null tokens are NULL."""
    return conform.map_null_tokens(derived(spark, sf, RAW_LISTINGS))


# --- SQL building blocks ----------------------------------------------------

# --- fixed values: written out, so that a changed constant of the engine shows --
_TOKENS = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA',"
    " 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)
_LOAN_ABSENT = (
    "maximum_loan_amount", "minimum_loan_amount", "income_criteria", "application_url", "scrape_date", "url",
    "bank_name", "loan_product_name", "documents_required", "special_benefits", "contact_info", "website_url",
    "bank_code",
)
_LOAN_POSITIONS = (
    "name", "description", "eligibility", "maximum_loan_amount", "minimum_loan_amount", "funding_amount", "interest_rate",
    "repayment_period", "age_criteria", "income_criteria", "contact", "application_url", "source", "scrape_date",
    "bank_code", "bank_name", "contact_info", "deadline", "documents_required", "loan_product_name", "row_id",
    "special_benefits", "url", "website_url",
)
_SCHOLARSHIP_POSITIONS = (
    "name", "description", "eligibility", "funding_amount", "deadline", "contact", "application_url", "source", "url",
    "scrape_date",
)
# ----------------------------------------------------------------------------


def _null_token(c):
    return f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END AS {c}"


_RAW = f"raw_listings AS ({RAW_LISTINGS})"
_LOADED = f"{_RAW}, loaded AS (SELECT row_id, {', '.join(_null_token(c) for c in _CELLS)} FROM raw_listings)"


def sql_clean_text(c):
    inner = f"regexp_replace(trim({c}, ' ' || chr(9) || chr(10) || chr(13)), '\\s+', ' ', 'g')"
    nulls = "('N/A', 'n/a', 'NA', 'None', 'none', '')"
    return f"regexp_replace(CASE WHEN {inner} IN {nulls} THEN 'N/A' ELSE {inner} END, '<[^>]+>', '', 'g')"


def _first_match(c, patterns, prefix="", suffix="", commas=False):
    out = ""
    for p, unit in patterns:
        value = f"regexp_extract({c}, '{p}', 1, 'i')"
        if commas:
            value = f"replace({value}, ',', '')"
        out += f" WHEN regexp_matches({c}, '{p}', 'i') THEN '{prefix}' || {value} || '{unit}{suffix}'"
    return out


_AMOUNT = [
    ("Rs\\.?\\s*([\\d,]+(?:\\.\\d{2})?)", ""),
    ("LKR\\s*([\\d,]+(?:\\.\\d{2})?)", ""),
    ("\\$([\\d,]+(?:\\.\\d{2})?)", ""),
    ("USD\\s*([\\d,]+(?:\\.\\d{2})?)", ""),
]


def sql_amount(c, words="varies|based|up to|minimum|maximum"):
    return (
        f"CASE WHEN {c} IS NULL OR {c} = 'N/A' THEN 'N/A'{_first_match(c, _AMOUNT, 'Rs. ', commas=True)}"
        f" WHEN contains({c}, '%') OR regexp_matches(lower({c}), '{words}') THEN trim({c})"
        f" WHEN {c} = '' THEN 'N/A' ELSE {c} END"
    )


def _extract(c, cases):
    return f"CASE WHEN {c} IS NULL OR {c} = 'N/A' THEN 'N/A'{cases} WHEN trim({c}) = '' THEN 'N/A' ELSE trim({c}) END"


def sql_period(c):
    return _extract(
        c,
        _first_match(
            c,
            [
                ("(\\d+)\\s*(?:year|yr|years|yrs)", " years"),
                ("(\\d+)\\s*(?:month|months|mo)", " months"),
                ("(\\d+)\\s*(?:installment|installments|EMI)", " installments"),
            ],
        ),
    )


def sql_rate(c):
    return _extract(
        c,
        f" WHEN regexp_matches({c}, '([\\d.]+)\\s*%') THEN regexp_extract({c}, '([\\d.]+)\\s*%', 1) || '%'"
        f" WHEN regexp_matches(lower({c}), 'free|zero|0%|interest-free') THEN 'Interest-Free'",
    )


def sql_age(c):
    span, single = "(\\d+)\\s*(?:to|-|and)\\s*(\\d+)", "(\\d+)\\s*(?:years?|yrs?)"
    return _extract(
        c,
        f" WHEN regexp_matches({c}, '{span}') THEN regexp_extract({c}, '{span}', 1) || '-' ||"
        f" regexp_extract({c}, '{span}', 2) || ' years'"
        f" WHEN regexp_matches({c}, '{single}', 'i') THEN regexp_extract({c}, '{single}', 1, 'i') || '+ years'",
    )


_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
_MONTHS_3 = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"


def sql_deadline(c):
    patterns = [
        ("(\\d{1,2}[-/]\\d{1,2}[-/]\\d{2,4})", ""),
        (f"(\\d{{1,2}}\\s+(?:{_MONTHS})\\s+\\d{{4}})", ""),
        (f"(\\d{{1,2}}\\s+(?:{_MONTHS_3})\\s+\\d{{4}})", ""),
    ]
    return _extract(
        c,
        _first_match(c, patterns)
        + f" WHEN regexp_matches(lower({c}), 'week|month|day|hour') THEN trim({c})"
        + f" WHEN regexp_matches(lower({c}), 'ongoing|rolling|continuous') THEN 'Ongoing'",
    )


def sql_eligibility(c):
    lines = (
        f"regexp_replace(regexp_replace(trim({c}, ' ' || chr(9) || chr(10) || chr(13)),"
        f" '\\n\\s*\\n', chr(10), 'g'), '\\n+', chr(10), 'g')"
    )
    return (
        f"CASE WHEN {c} IS NULL OR {c} = 'N/A' OR trim({c}) = '' THEN 'N/A' WHEN length({lines}) > 500"
        f" THEN substr({lines}, 1, 500) || '...' ELSE {lines} END"
    )


def _rule_text(*columns):
    return "lower(" + " || ' ' || ".join(f"coalesce({c}, 'nan')" for c in columns) + ")"


def _keyword_case(text_sql, rules, default):
    cases = "".join(f" WHEN regexp_matches({text_sql}, '{words}') THEN '{label}'" for words, label in rules)
    return f"CASE{cases} ELSE '{default}' END"


def sql_loan_type(a, b):
    return _keyword_case(
        _rule_text(a, b),
        [
            ("government|mohe", "Government Loan"),
            ("bank|boc|commercial|peoples|hnb|nsb|pabc", "Bank Loan"),
            ("buddhi|nsb", "NSB Loan"),
            ("dai|awarding", "DAI Related"),
        ],
        "Other",
    )


def sql_scholarship_type(a, b):
    return _keyword_case(
        _rule_text(a, b),
        [
            ("merit|academic|performance|exam|gpa", "Merit-Based"),
            ("need|income|poor|low-income|financial", "Need-Based"),
            ("sport|athletic|talent", "Talent-Based"),
            ("bursary|grant", "Grant/Bursary"),
            ("government|mahapola", "Government"),
        ],
        "General",
    )


def sql_region(a, b, c):
    return _keyword_case(
        _rule_text(a, b, c),
        [
            ("sri lanka|sliit|ousl", "Sri Lanka"),
            ("local|domestic", "Local"),
            ("foreign|overseas|international|abroad", "International"),
            ("both|local or", "Both"),
        ],
        "Unknown",
    )


def sql_duration(c):
    number = f"cast(regexp_extract({c}, '\\d+') AS bigint)"
    return (
        f"CASE WHEN {c} IS NULL OR NOT regexp_matches({c}, '\\d') THEN 'Unknown'"
        f" WHEN {number} <= 3 THEN 'Short-term (≤3 years)' WHEN {number} <= 7 THEN 'Medium-term (4-7 years)'"
        f" ELSE 'Long-term (>7 years)' END"
    )


def sql_score(fields):
    filled = " + ".join(f"CASE WHEN {f} IS NULL OR {f} = 'N/A' THEN 0 ELSE 1 END" for f in fields)
    return f"round(({filled}) * 100.0::DOUBLE / {len(fields)}, 2)"


def _kept(keys, source="loaded", order="row_id"):
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn"
        f" FROM {source}) WHERE rn = 1"
    )


_LOAN_CELLS = f"""
SELECT row_id, source, copies,
  {sql_clean_text('name')} AS name, {sql_clean_text('description')} AS description,
  {sql_clean_text('eligibility')} AS eligibility0, {sql_clean_text('contact')} AS contact,
  {sql_amount('funding_amount')} AS funding_amount, {sql_period('repayment_period')} AS repayment_period,
  {sql_rate('interest_rate')} AS interest_rate, {sql_age('age_criteria')} AS age_criteria, deadline
FROM kept"""
_SCHOLARSHIP_CELLS = f"""
SELECT row_id, source, copies,
  {sql_clean_text('name')} AS name, {sql_clean_text('description')} AS description,
  {sql_clean_text('eligibility')} AS eligibility0, {sql_clean_text('contact')} AS contact,
  {sql_amount('funding_amount', 'varies|based|up to|minimum')} AS funding_amount,
  {sql_deadline('deadline')} AS deadline
FROM kept"""
_WITH_COPIES = "counted AS (SELECT *, count(*) OVER (PARTITION BY name) AS copies FROM loaded)"
_KEPT = f"{_WITH_COPIES}, kept AS ({_kept('name', 'counted')})"

LOANS_SCORED = f"""{_LOADED}, {_KEPT}, cells AS ({_LOAN_CELLS}),
cells2 AS (SELECT * EXCLUDE (eligibility0), {sql_eligibility('eligibility0')} AS eligibility FROM cells),
scored AS (SELECT *, {sql_score(['name', 'description', 'eligibility', 'funding_amount', 'contact'])} AS data_quality_score,
  {sql_loan_type('name', 'description')} AS loan_type, {sql_duration('repayment_period')} AS loan_duration_category
  FROM cells2),
final AS (SELECT * FROM scored WHERE name IS DISTINCT FROM 'N/A')"""

SCHOLARSHIPS_SCORED = f"""{_LOADED}, {_KEPT}, cells AS ({_SCHOLARSHIP_CELLS}),
cells2 AS (SELECT * EXCLUDE (eligibility0), {sql_eligibility('eligibility0')} AS eligibility FROM cells),
scored AS (SELECT *,
  {sql_score(['name', 'description', 'eligibility', 'funding_amount', 'deadline', 'contact'])} AS data_quality_score,
  {sql_scholarship_type('name', 'description')} AS scholarship_type,
  {sql_region('name', 'description', 'eligibility')} AS eligible_region
  FROM cells2),
final AS (SELECT * FROM scored WHERE name IS DISTINCT FROM 'N/A' AND source IS DISTINCT FROM 'N/A')"""

_FILLED_NA = "'N/A' AS {}"


def _na_columns(columns):
    return ", ".join(_FILLED_NA.format(c) for c in columns)


# --- columns and filters ----------------------------------------------------


@check("null_tokens", f"WITH {_LOADED} SELECT * FROM loaded")
def _(spark, sf):
    return raw(spark, sf)


@check(
    "conform_loans",
    f"WITH {_LOADED} SELECT *, {_na_columns(_LOAN_ABSENT)} FROM loaded",
)
def _(spark, sf):
    return conform.conform_loans(raw(spark, sf))


@check(
    "conform_scholarships",
    f"WITH {_LOADED} SELECT name, description, eligibility, funding_amount, deadline, contact, source,"
    f" {_na_columns(['application_url', 'url', 'scrape_date'])} FROM loaded",
)
def _(spark, sf):
    return conform.conform_scholarships(raw(spark, sf))


_PRODUCTS = (
    "products AS (SELECT row_id, source, CASE WHEN row_id % 2 = 0 THEN name END AS name, 'Bank ' || source AS bank_name,"
    " name AS loan_product_name, contact AS contact_info, 'https://' || source AS website_url FROM loaded)"
)


@check(
    "alias_fallback",
    f"WITH {_LOADED}, {_PRODUCTS} SELECT row_id, coalesce(nullif(name, 'N/A'), bank_name) AS name,"
    " coalesce(contact_info, 'N/A') AS contact, website_url AS application_url FROM products",
)
def _(spark, sf):
    df = raw(spark, sf).select(
        "row_id",
        "source",
        F.when(F.col("row_id") % 2 == 0, F.col("name")).alias("name"),
        F.concat(F.lit("Bank "), F.col("source")).alias("bank_name"),
        F.col("name").alias("loan_product_name"),
        F.col("contact").alias("contact_info"),
        F.concat(F.lit("https://"), F.col("source")).alias("website_url"),
    )
    return conform.conform_loans(df, alias_fallback=True).select("row_id", "name", "contact", "application_url")


def _positions(names):
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, count(*) AS n_rows FROM orders o JOIN customer c"
        " ON o.o_custkey = c.c_custkey"
        for i, c in enumerate(names)
    )


def _column_positions(df):
    """Column order of a frame as rows, with the row count behind it."""
    cells = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name")) for i, c in enumerate(df.columns)]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select("n_rows", F.inline(F.array(*cells)))


@check("reorder_loans", _positions(_LOAN_POSITIONS))
def _(spark, sf):
    return _column_positions(conform.reorder_loans(conform.conform_loans(raw(spark, sf))))


@check("reorder_scholarships", _positions(_SCHOLARSHIP_POSITIONS))
def _(spark, sf):
    return _column_positions(conform.reorder_scholarships(conform.conform_scholarships(raw(spark, sf))))


@check(
    "preview",
    f"WITH {_LOADED} SELECT row_id, substr(name, 1, 65) AS short_name, funding_amount, deadline,"
    " substr(coalesce(eligibility, 'nan'), 1, 100) || '...' AS eligibility_start FROM loaded ORDER BY row_id LIMIT 5",
)
def _(spark, sf):
    columns = (
        "row_id", preview.short_name(F.col("name")).alias("short_name"), "funding_amount", "deadline",
        preview.elided(F.col("eligibility")).alias("eligibility_start"),
    )
    return preview.preview(raw(spark, sf), columns, ORDER)


@check("filter_named", f"WITH {_RAW} SELECT * FROM raw_listings WHERE name IS DISTINCT FROM 'N/A'")
def _(spark, sf):
    return filters.named(derived(spark, sf, RAW_LISTINGS))


@check(
    "filter_named_sourced",
    f"WITH {_RAW}, r AS (SELECT row_id, name, CASE WHEN row_id % 3 = 0 THEN 'N/A' ELSE source END AS source"
    " FROM raw_listings) SELECT * FROM r WHERE name IS DISTINCT FROM 'N/A' AND source IS DISTINCT FROM 'N/A'",
)
def _(spark, sf):
    df = derived(spark, sf, RAW_LISTINGS)
    source = F.when(F.col("row_id") % 3 == 0, "N/A").otherwise(F.col("source"))
    return filters.named_and_sourced(df.select("row_id", "name", source.alias("source")))


@check("valid_name", f"WITH {_RAW} SELECT row_id, name FROM raw_listings WHERE name NOT IN ('', 'N/A')")
def _(spark, sf):
    return filters.valid_name(derived(spark, sf, RAW_LISTINGS).select("row_id", "name"))


# --- keep-first -------------------------------------------------------------


@check("dedup_name", f"WITH {_LOADED} {_kept('name')}")
def _(spark, sf):
    return dedup.keep_first_by_name(raw(spark, sf), ORDER)


@check("dedup_name_source", f"WITH {_LOADED} {_kept('name, source')}")
def _(spark, sf):
    return dedup.keep_first_by_name_and_source(raw(spark, sf), ORDER)


@check("dedup_in_feed", f"WITH {_RAW} {_kept('source, name', 'raw_listings')}")
def _(spark, sf):
    return dedup.keep_first_in_feed(derived(spark, sf, RAW_LISTINGS), ORDER)


@check(
    "dedup_in_feed_product",
    f"WITH {_RAW}, products AS (SELECT row_id, source, name AS loan_product_name FROM raw_listings)"
    f" {_kept('source, loan_product_name', 'products')}",
)
def _(spark, sf):
    products = derived(spark, sf, RAW_LISTINGS).select("row_id", "source", F.col("name").alias("loan_product_name"))
    return dedup.keep_first_in_feed(products, ORDER, key="loan_product_name")


@check("dedup_documents", f"{_kept('text', 'documents', 'doc_id')}")
def _(spark, sf):
    return dedup.keep_first(table(spark, sf, "documents"), ["text"], ["doc_id"])


_TWO_FEEDS = (
    "feeds AS (SELECT 0 AS feed, row_id, name, source, funding_amount, deadline, description FROM loaded"
    " UNION ALL SELECT 1, row_id, name, source, NULL, NULL, NULL FROM loaded)"
)


def _two_feeds(spark, sf):
    df = raw(spark, sf)
    full = df.select("row_id", "name", "source", "funding_amount", "deadline", "description")
    return [full, df.select("source", "row_id", "name")]


@check("union_feeds", f"WITH {_LOADED}, {_TWO_FEEDS} SELECT * EXCLUDE (feed) FROM feeds")
def _(spark, sf):
    return union.union_feeds(_two_feeds(spark, sf))


@check("dedup_merge", f"WITH {_LOADED}, {_TWO_FEEDS} {_kept('name, source', 'feeds', 'feed, row_id')}")
def _(spark, sf):
    return merge.merge(_two_feeds(spark, sf), ORDER)[1].withColumnRenamed("_feed", "feed")


@check(
    "merge_summary",
    f"WITH {_LOADED}, {_TWO_FEEDS}, merged AS ({_kept('name, source', 'feeds', 'feed, row_id')})"
    " SELECT count(*) AS total, count(DISTINCT source) AS sources,"
    " count(*) FILTER (funding_amount IS DISTINCT FROM 'N/A') AS with_amount,"
    " count(*) FILTER (deadline IS DISTINCT FROM 'N/A') AS with_deadline,"
    " count(*) FILTER (description IS DISTINCT FROM '') AS with_description FROM merged",
)
def _(spark, sf):
    return report.merge_summary(merge.merge(_two_feeds(spark, sf), ORDER)[1])


@check(
    "expand_dimension",
    "SELECT c_custkey AS row_id, 'Approved institute: ' || c_name AS name,"
    " 'Degree institute, code: ' || c_custkey || ' / ' || c_mktsegment AS description, 'Rs. 600,000' AS funding_amount,"
    " 'N/A - Ongoing' AS deadline, 'scheme' AS source FROM customer",
)
def _(spark, sf):
    institutes = table(spark, sf, "customer").withColumnRenamed("c_custkey", "row_id")
    templates = {
        "name": ("Approved institute: %s", ["c_name"]),
        "description": ("Degree institute, code: %s / %s", ["row_id", "c_mktsegment"]),
    }
    constants = {"funding_amount": "Rs. 600,000", "deadline": "N/A - Ongoing", "source": "scheme"}
    return expand.expand_dimension(institutes, templates, constants, ORDER)


# --- text, extraction, classes, scores: one column each ----------------------


def _column_check(key, column, sql, expression, source=RAW_LISTINGS, name="value"):
    @check(key, f"WITH raw AS ({source}) SELECT row_id, {sql} AS {name} FROM raw")
    def _(spark, sf):
        return derived(spark, sf, source).select("row_id", expression(F.col(column)).alias(name))


_WS = "' ' || chr(9) || chr(10) || chr(13)"
_column_check("text_trim", "name", f"trim(name, {_WS})", text.strip)
_column_check("text_collapse", "description", "regexp_replace(description, '\\s+', ' ', 'g')", text.collapse_spaces)
_column_check(
    "text_nulls",
    "description",
    "CASE WHEN description IN ('N/A', 'n/a', 'NA', 'None', 'none', '') THEN 'N/A' ELSE description END",
    text.null_like,
)
_column_check("clean_eligibility", "eligibility", sql_eligibility("eligibility"), text.clean_eligibility)
_column_check("extract_amount", "funding_amount", sql_amount("funding_amount"), extract.amount)
_column_check(
    "extract_funding", "funding_amount", sql_amount("funding_amount", "varies|based|up to|minimum"), extract.funding
)
_column_check("extract_period", "repayment_period", sql_period("repayment_period"), extract.period)
_column_check("extract_rate", "interest_rate", sql_rate("interest_rate"), extract.rate)
_column_check("extract_age", "age_criteria", sql_age("age_criteria"), extract.age)
_column_check("extract_deadline", "deadline", sql_deadline("deadline"), extract.deadline)
_column_check("duration_bucket", "repayment_period", sql_duration("repayment_period"), classify.duration_bucket)


@check(
    "clean_text",
    f"WITH {_RAW} SELECT row_id, "
    + ", ".join(f"{sql_clean_text(c)} AS {c}" for c in ("name", "description", "eligibility", "contact"))
    + " FROM raw_listings",
)
def _(spark, sf):
    df = derived(spark, sf, RAW_LISTINGS)
    return df.select(
        "row_id", *[text.clean_text(F.col(c)).alias(c) for c in ("name", "description", "eligibility", "contact")]
    )


@check("clean_text_documents", f"SELECT doc_id, {sql_clean_text('text')} AS text FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.clean_text(F.col("text")).alias("text"))


@check("strip_tags", "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.strip_tags(F.col("html")).alias("text"))


@check("loan_type", f"WITH {_RAW} SELECT row_id, {sql_loan_type('name', 'description')} AS value FROM raw_listings")
def _(spark, sf):
    words = text.rule_text(F.col("name"), F.col("description"))
    return derived(spark, sf, RAW_LISTINGS).select("row_id", classify.loan_type(words).alias("value"))


@check(
    "scholarship_type",
    f"WITH {_RAW} SELECT row_id, {sql_scholarship_type('name', 'description')} AS value FROM raw_listings",
)
def _(spark, sf):
    words = text.rule_text(F.col("name"), F.col("description"))
    return derived(spark, sf, RAW_LISTINGS).select("row_id", classify.scholarship_type(words).alias("value"))


@check(
    "eligible_region",
    f"WITH {_RAW} SELECT row_id, {sql_region('name', 'description', 'eligibility')} AS value FROM raw_listings",
)
def _(spark, sf):
    words = text.rule_text(F.col("name"), F.col("description"), F.col("eligibility"))
    return derived(spark, sf, RAW_LISTINGS).select("row_id", classify.eligible_region(words).alias("value"))


@check(
    "quality_loans",
    f"WITH {_LOADED} SELECT row_id, {sql_score(['name', 'description', 'eligibility', 'funding_amount', 'contact'])}"
    " AS score FROM loaded",
)
def _(spark, sf):
    return raw(spark, sf).select("row_id", score.quality_score(score.LOAN_FIELDS).alias("score"))


_SQL_SCHOLARSHIP_SCORE = sql_score(["name", "description", "eligibility", "funding_amount", "deadline", "contact"])


@check("quality_scholarships", f"WITH {_LOADED} SELECT row_id, {_SQL_SCHOLARSHIP_SCORE} AS score FROM loaded")
def _(spark, sf):
    return raw(spark, sf).select("row_id", score.quality_score(score.SCHOLARSHIP_FIELDS).alias("score"))


@check(
    "quality_band",
    f"WITH {_LOADED}, s AS (SELECT row_id, {_SQL_SCHOLARSHIP_SCORE} AS score FROM loaded)"
    " SELECT row_id, CASE WHEN score >= 80 THEN 'Excellent' WHEN score >= 60 THEN 'Good'"
    " WHEN score >= 40 THEN 'Average' ELSE 'Poor' END AS band FROM s",
)
def _(spark, sf):
    band = classify.quality_band(score.quality_score(score.SCHOLARSHIP_FIELDS))
    return raw(spark, sf).select("row_id", band.alias("band"))


# --- clean chains -----------------------------------------------------------

_LOAN_KEPT_COLUMNS = (
    "row_id, source, name, description, eligibility, contact, funding_amount, repayment_period, interest_rate,"
    " age_criteria, deadline, data_quality_score, loan_type, loan_duration_category"
)


@check("clean_loans", f"WITH {LOANS_SCORED} SELECT {_LOAN_KEPT_COLUMNS}, {_na_columns(_LOAN_ABSENT)} FROM final")
def _(spark, sf):
    return clean.clean_loans(raw(spark, sf), ORDER).table(keep_order=True)


@check(
    "clean_scholarships",
    f"WITH {SCHOLARSHIPS_SCORED} SELECT row_id, source, name, description, eligibility, contact, funding_amount,"
    f" deadline, data_quality_score, scholarship_type, eligible_region,"
    f" {_na_columns(['application_url', 'url', 'scrape_date'])} FROM final",
)
def _(spark, sf):
    return clean.clean_scholarships(raw(spark, sf), ORDER).table(keep_order=True)


def _report_sql(scored, breakdowns, fields):
    parts = [
        "SELECT 'rows' AS section, 'original' AS metric, (SELECT count(*) FROM loaded)::DOUBLE AS value",
        "SELECT 'rows', 'cleaned', count(*)::DOUBLE FROM final",
        "SELECT 'rows', 'removed', ((SELECT count(*) FROM loaded) - count(*))::DOUBLE FROM final",
        "SELECT 'rows', 'removal_rate', round(((SELECT count(*) FROM loaded) - count(*)) * 100.0::DOUBLE"
        " / (SELECT count(*) FROM loaded), 2) FROM final",
        "SELECT 'score', 'mean', round(avg(data_quality_score), 2) FROM final",
        "SELECT 'score', 'median', round(median(data_quality_score), 2) FROM final",
        "SELECT 'score', 'min', min(data_quality_score) FROM final",
        "SELECT 'score', 'max', max(data_quality_score) FROM final",
        "SELECT 'band', 'Excellent', count(*) FILTER (data_quality_score >= 80)::DOUBLE FROM final",
        "SELECT 'band', 'Good', count(*) FILTER (data_quality_score >= 60 AND data_quality_score < 80)::DOUBLE FROM final",
        "SELECT 'band', 'Average', count(*) FILTER (data_quality_score >= 40 AND data_quality_score < 60)::DOUBLE FROM final",
        "SELECT 'band', 'Poor', count(*) FILTER (data_quality_score < 40)::DOUBLE FROM final",
    ]
    for f in fields:
        filled = f"count(*) FILTER ({f} IS DISTINCT FROM 'N/A')"
        parts.append(f"SELECT 'filled', '{f}', {filled}::DOUBLE FROM final")
        parts.append(f"SELECT 'filled_percent', '{f}', round({filled} * 100.0::DOUBLE / count(*), 2) FROM final")
    for b in breakdowns:
        parts.append(f"SELECT '{b}', {b}, count(*)::DOUBLE FROM final WHERE {b} IS NOT NULL GROUP BY {b}")
    return f"WITH {scored} " + " UNION ALL ".join(parts)


LOANS_REPORT = _report_sql(LOANS_SCORED, report.LOAN_BREAKDOWNS, report.LOAN_COMPLETENESS)


@check("report_loans", LOANS_REPORT)
def _(spark, sf):
    return clean.clean_loans(raw(spark, sf), ORDER).report()


@check(
    "report_scholarships",
    _report_sql(SCHOLARSHIPS_SCORED, report.SCHOLARSHIP_BREAKDOWNS, report.SCHOLARSHIP_COMPLETENESS),
)
def _(spark, sf):
    return clean.clean_scholarships(raw(spark, sf), ORDER).report()


_STAGES = (
    "SELECT (SELECT count(*) FROM loaded) AS loaded, (SELECT count(*) FROM loaded) - count(*) AS removed_duplicates,"
    " count(*) AS after_dedup, count(*) - (SELECT count(*) FROM final) AS removed_unnamed,"
    " (SELECT count(*) FROM final) AS after_filter FROM kept"
)


@check("stage_counts", f"WITH {LOANS_SCORED} {_STAGES}")
def _(spark, sf):
    return clean.clean_loans(raw(spark, sf), ORDER).stages()


# --- report parts -----------------------------------------------------------


def _loans(spark, sf):
    return clean.clean_loans(raw(spark, sf), ORDER).table()


def _scholarships(spark, sf):
    return clean.clean_scholarships(raw(spark, sf), ORDER).table()


@check(
    "removal_summary",
    f"WITH {LOANS_SCORED}, n AS (SELECT (SELECT count(*) FROM loaded) AS original, count(*) AS cleaned FROM final)"
    " SELECT original, cleaned, original - cleaned AS removed,"
    " round((original - cleaned) * 100.0::DOUBLE / original, 2) AS removal_rate FROM n",
)
def _(spark, sf):
    return report.removal_summary(raw(spark, sf), _loans(spark, sf))


@check(
    "score_stats",
    f"WITH {LOANS_SCORED} SELECT round(avg(data_quality_score), 2) AS mean_score,"
    " round(median(data_quality_score), 2) AS median_score, min(data_quality_score) AS min_score,"
    " max(data_quality_score) AS max_score FROM final",
)
def _(spark, sf):
    return report.score_stats(_loans(spark, sf))


@check(
    "band_counts",
    f"WITH {SCHOLARSHIPS_SCORED} SELECT count(*) FILTER (data_quality_score >= 80) AS excellent,"
    " count(*) FILTER (data_quality_score >= 60 AND data_quality_score < 80) AS good,"
    " count(*) FILTER (data_quality_score >= 40 AND data_quality_score < 60) AS average,"
    " count(*) FILTER (data_quality_score < 40) AS poor FROM final",
)
def _(spark, sf):
    return report.band_counts(_scholarships(spark, sf))


def _counts_check(column, scored, frame):
    @check(
        f"counts_{column}",
        f"WITH {scored} SELECT {column}, count(*) AS n FROM final WHERE {column} IS NOT NULL GROUP BY {column}",
    )
    def _(spark, sf):
        return report.value_counts(frame(spark, sf), column)


_counts_check("loan_type", LOANS_SCORED, _loans)
_counts_check("loan_duration_category", LOANS_SCORED, _loans)
_counts_check("source", LOANS_SCORED, _loans)
_counts_check("scholarship_type", SCHOLARSHIPS_SCORED, _scholarships)
_counts_check("eligible_region", SCHOLARSHIPS_SCORED, _scholarships)


@check(
    "completeness",
    f"WITH {SCHOLARSHIPS_SCORED} "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) FILTER ({f} IS DISTINCT FROM 'N/A') AS filled, count(*) AS total,"
        f" round(count(*) FILTER ({f} IS DISTINCT FROM 'N/A') * 100.0::DOUBLE / count(*), 2) AS filled_percent FROM final"
        for f in report.SCHOLARSHIP_COMPLETENESS
    ),
)
def _(spark, sf):
    return report.completeness(_scholarships(spark, sf), report.SCHOLARSHIP_COMPLETENESS)


@check(
    "top_values",
    f"WITH {_LOADED} SELECT name, count(*) AS n FROM loaded WHERE name IS NOT NULL GROUP BY name"
    " ORDER BY n DESC, name LIMIT 10",
)
def _(spark, sf):
    return report.value_counts(raw(spark, sf), "name", limit=10)


@check(
    "count_by_first_seen",
    f"WITH {_LOADED} SELECT source, count(*) AS n FROM loaded GROUP BY source ORDER BY min(row_id)",
)
def _(spark, sf):
    return report.count_by_first_seen(raw(spark, sf), "source", ORDER)


@check(
    "feed_quality",
    f"WITH {_RAW} SELECT source, count(*) AS total,"
    " count(*) FILTER (funding_amount IS DISTINCT FROM 'N/A') AS with_funding_amount,"
    " count(*) FILTER (deadline IS DISTINCT FROM 'N/A') AS with_deadline,"
    " count(*) FILTER (eligibility IS DISTINCT FROM 'N/A') AS with_eligibility,"
    " count(*) FILTER (description IS DISTINCT FROM '') AS with_description FROM raw_listings GROUP BY source",
)
def _(spark, sf):
    return report.feed_quality(derived(spark, sf, RAW_LISTINGS))
