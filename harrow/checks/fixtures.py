"""Listing-shaped inputs derived from the given tables.

The tables hold no amounts, dates or award texts, so each rule gets its inputs
from a SELECT over whole tables. The same text runs on Spark and on DuckDB.
"""

from pyspark.sql import functions as F

from harrow.sources import feeds

RAW_LISTINGS = """
SELECT o.o_orderkey AS row_id,
  'feed' || cast(o.o_custkey % 7 AS string) AS source,
  CASE WHEN o.o_orderkey % 41 = 0 THEN 'N/A' WHEN o.o_orderkey % 43 = 0 THEN NULL
       ELSE CASE o.o_orderkey % 9 WHEN 0 THEN 'Buddhi Trust ' WHEN 1 THEN 'Government Scheme ' WHEN 2 THEN 'Merit Award '
            WHEN 3 THEN 'Sports Bursary ' WHEN 4 THEN 'Approved DAI: ' WHEN 5 THEN '  People' || chr(9) || 'Fund  '
            WHEN 6 THEN '<b>Aid</b> ' WHEN 7 THEN 'Research Grant ' ELSE 'Stream ' END || c.c_mktsegment || cast(o.o_custkey % 97 AS string) END AS name,
  CASE o.o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'For low-income students in Sri Lanka' WHEN 2 THEN 'Study abroad' || chr(10) || chr(10) || 'or local'
       WHEN 3 THEN 'none' WHEN 4 THEN '<p>International <i>GPA</i> based</p>' WHEN 5 THEN 'Daily bank stipend' ELSE 'Open to both <br>' END AS description,
  CASE o.o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN repeat('Age 25 years or below; ', 30) WHEN 2 THEN 'n/a' WHEN 3 THEN 'Must enroll' || chr(10) || ' ' || chr(10) || 'Pass A/L' ELSE 'domestic only' END AS eligibility,
  CASE o.o_orderkey % 9 WHEN 0 THEN 'Rs. ' || cast(cast(floor(o.o_totalprice) AS bigint) AS string) || '/- (Maximum)' WHEN 1 THEN 'LKR 1,' || lpad(cast(o.o_orderkey % 1000 AS string), 3, '0') || ',000.50'
       WHEN 2 THEN 'USD ' || cast(o.o_orderkey % 5000 AS string) WHEN 3 THEN '50% of tuition fee' WHEN 4 THEN 'Varies by field (Rs. 600,000 - Rs. 1,500,000)' WHEN 5 THEN 'scholars, see page' WHEN 6 THEN 'N/A' WHEN 7 THEN '$2,500 then Rs 10' ELSE ' Based on course fee ' END AS funding_amount,
  CASE o.o_orderkey % 7 WHEN 0 THEN 'Up to ' || cast(o.o_orderkey % 12 AS string) || ' years' WHEN 1 THEN '60 months' WHEN 2 THEN '24 EMI' WHEN 3 THEN 'N/A' WHEN 4 THEN '5 yrs or 60 months' WHEN 5 THEN 'flexible' ELSE NULL END AS repayment_period,
  CASE o.o_orderkey % 6 WHEN 0 THEN '12.5 % p.a.' WHEN 1 THEN '0%' WHEN 2 THEN 'interest-free' WHEN 3 THEN 'Competitive (varies)' WHEN 4 THEN NULL ELSE 'N/A' END AS interest_rate,
  CASE o.o_orderkey % 5 WHEN 0 THEN '18-65 years' WHEN 1 THEN '18 to 50' WHEN 2 THEN '25 years or below' WHEN 3 THEN 'N/A' ELSE 'any' END AS age_criteria,
  CASE o.o_orderkey % 8 WHEN 0 THEN 'by 31/12/2025 noon' WHEN 1 THEN '15 march 2026' WHEN 2 THEN '1 Feb 2026' WHEN 3 THEN 'Within 6 weeks' WHEN 4 THEN 'N/A - Ongoing' WHEN 5 THEN 'rolling basis' WHEN 6 THEN 'N/A' ELSE 'TBA' END AS deadline,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN NULL ELSE 'Visit nearest branch' END AS contact
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

RAW_BLOCKS = """
SELECT o_orderkey AS block_id,
  CASE o_orderkey % 16
    WHEN 0 THEN 'Merit scholarship of Rs. 50,000 before 31/12/2025'
    WHEN 1 THEN 'Grant: USD 1,500.00 per year' || chr(10) || 'Application deadline: 15 March 2026' || chr(10) || 'Apply now'
    WHEN 2 THEN 'Closing Date 1-2-26' || chr(10) || 'Contact: office' || cast(o_custkey AS string) || '@example.org or call'
    WHEN 3 THEN 'deadline: ' || repeat('see the long notice ', 8) || chr(10) || 'or 5/6/2026'
    WHEN 4 THEN 'Bursary worth LKR ' || cast(o_orderkey % 900 AS string) || ',000 for 24 months'
    WHEN 5 THEN 'Status: Doctoral candidates/PhD students | Subject area: Engineering | Application deadline: 30 June 2026 | 3 years'
    WHEN 6 THEN 'Status: | Graduates | Subject area: Law, Arts | stipend'
    WHEN 7 THEN 'Status: Undergraduate | monthly allowance of € 934 and 12 months'
    WHEN 8 THEN 'EUR 1,200 fully funded'
    WHEN 9 THEN 'fully funded summer course'
    WHEN 10 THEN 'short'
    WHEN 11 THEN 'Email' || chr(10) || ' help@example.com' || chr(10) || 'award 2,000'
    WHEN 12 THEN 'Loan assistance, 2500 USD, 12 june 2026'
    WHEN 13 THEN 'line one' || chr(10) || '  Closing soon: ask us  ' || chr(10) || 'deadline tba'
    WHEN 14 THEN '$ 3,400 or Rs.20'
    ELSE 'Masters study scholarship ' || cast(o_custkey AS string) END AS text
FROM orders
"""

# --- pages: one HTML template per feed shape --------------------------------

_KEY, _CUSTOMER = "cast(o_orderkey AS string)", "cast(o_custkey AS string)"

SHAPES = (
    # h3 headings, each followed by text, an amount and a link
    f"""'<html><body><div><h3>Scheme ' || {_CUSTOMER} || '</h3><p>Helps students &amp; families pay fees.</p><div>Rs. '
      || cast(o_orderkey % 900 + 100 AS string) || ',000' || chr(10) || 'Deadline: 31/12/2025' || chr(10)
      || '</div><a href="/apply/' || {_CUSTOMER} || '">Apply</a></div></body></html>'""",
    # an article whose list items, paragraphs or headings are the listings
    f"""'<html><body><article><h2>Student grant scheme ' || {_CUSTOMER} || '</h2><a href="/s/' || {_CUSTOMER} || '">more</a>'
      || CASE o_orderkey % 3
           WHEN 0 THEN '<ul><li>short</li><li>Grant no ' || {_CUSTOMER} || ' of LKR 5,000</li></ul><p>A scholarship paragraph here.</p>'
           WHEN 1 THEN '<ul><li>nothing of note</li></ul><p>A bursary paid by 1/2/2026 for some.</p>'
           ELSE '<p>Plain text only.</p>' END || '</article></body></html>'""",
    # one article with an eligibility section
    f"""'<html><body><h1 class="entry-title">Award ' || {_CUSTOMER} || '</h1><div class="post entry-content"><p>First para.</p>'
      || '<p>Second para.</p><p>Deadline: 15 March 2026' || chr(10) || '</p><h3>Eligibility</h3>'
      || '<p>Eligible countries: Sri Lanka</p><ul><li>GPA above 2.0</li><li>abc</li><li>Full-time degree</li></ul>'
      || '<p>- own laptop</p></div></body></html>'""",
    # a database entry with labelled fields
    f"""'<html><body><div><h3><a href="?type=a&amp;id=' || {_KEY} || '">Research stay ' || {_CUSTOMER} || '</a></h3>'
      || '<p>Stay abroad</p><span>Status: PhD students</span><span>Subject area: Physics</span>'
      || '<span>Application deadline: 30 June 2026</span><span>€ 1,200 for 24 months</span></div></body></html>'""",
)


def shape_pages(shape):
    """One page of one shape per order."""
    return f"""
SELECT o_orderkey AS page_id, 'https://feed{shape}.example.org/p/' || {_KEY} AS url, {SHAPES[shape]} AS html FROM orders
"""


# all four shapes in turn, one page per order
RAW_PAGES = f"""
SELECT o_orderkey AS page_id,
  'https://feed' || cast(o_orderkey % 4 AS string) || '.example.org/p/' || {_KEY} AS url,
  CASE o_orderkey % 4 WHEN 0 THEN {SHAPES[0]} WHEN 1 THEN {SHAPES[1]} WHEN 2 THEN {SHAPES[2]} ELSE {SHAPES[3]} END AS html
FROM orders
"""


_DEALT = 4 << 20  # bytes of a table's files for each part that it is dealt into


def table(spark, sf_dir, name):
    """A given table, dealt out over the cores, and into more parts as it grows: each is one row group, which a scan
    cannot split. Rows are dealt by their place in the scan: a plain repartition sorts each scan task's rows first."""
    path = f"{sf_dir}/{name}.parquet"
    parts = max(spark.sparkContext.defaultParallelism, feeds.size(spark, path) // _DEALT)
    return spark.read.parquet(path).repartition(parts, F.monotonically_increasing_id())


def derived(spark, sf_dir, select):
    """Run one of the SELECTs above over the tables of a folder."""
    orders, customer = table(spark, sf_dir, "orders"), spark.read.parquet(f"{sf_dir}/customer.parquet")
    text = select.replace("FROM orders", "FROM {orders}").replace("JOIN customer", "JOIN {customer}")
    used = {"orders": orders, "customer": customer}
    return spark.sql(text, **{k: v for k, v in used.items() if "{" + k + "}" in text})
