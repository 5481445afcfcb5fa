"""Checks that go through files: feeds written, found, read back and cleaned."""

from pyspark.sql import functions as F

from harrow.checks import listings
from harrow.checks.fixtures import RAW_LISTINGS, derived, table
from harrow.checks.listings import check
from harrow.plans import clean, merge, runs
from harrow.session import stage_path
from harrow.sources import feeds, sinks

_STAMP = "20260101_000000"
_SHORT = ("row_id", "name", "source")


def _write_feeds(spark, sf):
    """Two loan feeds with differing headers and one scholarship feed."""
    folder = stage_path(spark, "feeds")
    raw = derived(spark, sf, RAW_LISTINGS)
    sinks.write_feed_csv(raw, folder, "a_loans", _STAMP)
    sinks.write_feed_csv(raw.select(*_SHORT), folder, "b_institutions", _STAMP)
    sinks.write_feed_csv(raw.select(*_SHORT), folder, "c_scholarships", _STAMP)
    return folder


_CELLS = ", ".join(listings._CELLS)


@check(
    "feed_files",
    f"WITH {listings._LOADED} SELECT row_id, {_CELLS} FROM loaded UNION ALL BY NAME"
    " SELECT row_id, name, source FROM loaded",
)
def _(spark, sf):
    loaded = feeds.load_loan_feeds(spark, _write_feeds(spark, sf)).drop(*feeds.LOAD_ORDER)
    return loaded.withColumn("row_id", F.col("row_id").cast("long"))


@check("feed_json", f"WITH {listings._RAW} SELECT * FROM raw_listings")
def _(spark, sf):
    raw = derived(spark, sf, RAW_LISTINGS)
    path = sinks.write_feed_json(raw, stage_path(spark, "json"), "a_loans", _STAMP)
    return spark.read.schema(raw.schema).json(path)


_FILE_COLUMNS = (
    "source", "name", "description", "eligibility", "contact", "funding_amount", "repayment_period", "interest_rate",
    "age_criteria", "loan_type", "loan_duration_category",
)


def _write_ordered(spark, sf, name):
    """One feed whose load order is the order of its rows: one part per range."""
    folder = stage_path(spark, "feeds")
    raw = derived(spark, sf, RAW_LISTINGS).repartitionByRange("row_id").sortWithinPartitions("row_id")
    sinks.write_feed_csv(raw, folder, name, _STAMP)
    return folder


def _cleaned(spark, stable, columns):
    table = feeds.read_feed_files(spark, feeds.parts(spark, stable), skip_ragged=False)
    return table.select(F.col("row_id").cast("long"), F.col("data_quality_score").cast("double"), *columns)


@check(
    "clean_loan_files",
    f"WITH {listings.LOANS_SCORED} SELECT row_id, data_quality_score, "
    + ", ".join(listings._null_token(c) for c in _FILE_COLUMNS)
    + " FROM final",
)
def _(spark, sf):
    folder = _write_ordered(spark, sf, "a_loans")
    return _cleaned(spark, runs.clean_loan_folder(spark, folder, f"{folder}-out", stamp=_STAMP), _FILE_COLUMNS)


_SCHOLARSHIP_COLUMNS = (
    "source", "name", "description", "eligibility", "contact", "funding_amount", "deadline", "scholarship_type",
    "eligible_region",
)


@check(
    "clean_scholarship_files",
    f"WITH {listings.SCHOLARSHIPS_SCORED} SELECT data_quality_score, "
    + ", ".join(listings._null_token(c) for c in _SCHOLARSHIP_COLUMNS)
    + " FROM final",
)
def _(spark, sf):
    folder = _write_ordered(spark, sf, "c_scholarships")
    stable = runs.clean_scholarship_folder(spark, folder, f"{folder}-out", stamp=_STAMP)
    table = feeds.read_feed_files(spark, feeds.parts(spark, stable), skip_ragged=False)
    return table.select(F.col("data_quality_score").cast("double"), *_SCHOLARSHIP_COLUMNS)


@check(
    "report_file",
    f"SELECT section || ' | ' || metric || ' | ' || CASE WHEN section IN ('score', 'filled_percent')"
    f" OR metric = 'removal_rate' THEN printf('%.2f', value) ELSE value::BIGINT::VARCHAR END AS line"
    f" FROM ({listings.LOANS_REPORT})",
)
def _(spark, sf):
    report = clean.clean_loans(listings.raw(spark, sf), listings.ORDER).report()
    path = sinks.write_report(report, stage_path(spark, "report"), "loans", _STAMP)
    return spark.read.text(path).withColumnRenamed("value", "line")


_MERGED = ("listing_id", "name", "source", "funding_amount", "deadline")
_MERGED_FEEDS = (
    "feeds AS (SELECT 0 AS feed, row_id AS listing_id, name, source, funding_amount, deadline FROM loaded"
    " UNION ALL SELECT 1, row_id, name, source, NULL, NULL FROM loaded)"
)


@check(
    "merged_files",
    f"WITH {listings._LOADED}, {_MERGED_FEEDS},"
    f" merged AS ({listings._kept('name, source', 'feeds', 'feed, listing_id')})"
    f" SELECT 'csv' AS kind, {', '.join(_MERGED)}, 'broken' AS failed FROM merged"
    f" UNION ALL SELECT 'json', {', '.join(_MERGED)}, 'broken' FROM feeds",
)
def _(spark, sf):
    """Both merged files read back; one feed of three fails and is left out."""
    def full(s):
        return listings.raw(s, sf).withColumn("listing_id", F.col("row_id")).select("row_id", *_MERGED)

    registry = [
        merge.Feed("full", full),
        merge.Feed("short", lambda s: full(s).select("source", "row_id", "name", "listing_id")),
        merge.Feed("broken", lambda s: full(s).withColumn("name", F.raise_error(F.lit("no such page")).cast("string"))),
    ]
    folder = stage_path(spark, "merged")
    failed = ",".join(merge.ingest(spark, registry, listings.ORDER, folder=folder, stamp=_STAMP).failed)
    base = f"{folder}/all_scholarships_{_STAMP}"
    table = feeds.read_feed_files(spark, feeds.parts(spark, f"{base}.csv"), skip_ragged=False)
    table = table.withColumn("listing_id", F.col("listing_id").cast("long"))
    buffer = spark.read.schema("listing_id long, name string, source string, funding_amount string, deadline string")
    both = [("csv", table), ("json", buffer.json(f"{base}.json"))]
    csv, json = [df.select(F.lit(kind).alias("kind"), *_MERGED, F.lit(failed).alias("failed")) for kind, df in both]
    return csv.unionByName(json)


@check(
    "feed_rejects",
    f"WITH {listings._RAW} SELECT 'a_loans' AS feed, 'read' AS reason, count(*) AS n_rows, sum(row_id)::BIGINT AS ids"
    " FROM raw_listings UNION ALL SELECT 'b_loans', 'row longer than header', 0, 0"
    " UNION ALL SELECT 'd_loans', 'no header', 0, 0",
)
def _(spark, sf):
    """One good feed, one with every other row too long, one file without a header.

    Runs jobs while the frame is built: the feeds are written, and read once.
    """
    folder = stage_path(spark, "feeds")
    raw = derived(spark, sf, RAW_LISTINGS)
    sinks.write_feed_csv(raw, folder, "a_loans", _STAMP)
    lines = F.explode(F.array(F.concat_ws(",", "row_id", "source"), F.concat_ws(",", "row_id", "source", "row_id")))
    ragged = raw.select(lines.alias("row_id,source"))
    ragged.write.option("header", True).option("sep", "\u0001").csv(f"{folder}/b_loans_{_STAMP}.csv")
    raw.select(F.lit("").alias("value")).where("value = 'x'").write.text(f"{folder}/d_loans_{_STAMP}.csv")

    def feed(path):
        return F.regexp_extract(path, r"/(\w_loans)_[^/]*\.csv", 1).alias("feed")

    read = feeds.read_feeds(spark, feeds.discover(spark, folder, feeds.LOAN_NAMES))
    kept = read.table.groupBy(feed("_file"), F.lit("read").alias("reason"))
    kept = kept.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("row_id").cast("long")).alias("ids"))
    none = F.lit(0).cast("long")
    left = read.rejected.select(feed("file"), "reason").distinct()
    return kept.unionByName(left.select("feed", "reason", none.alias("n_rows"), none.alias("ids")))


@check(
    "feed_broken",
    f"WITH {listings._LOADED} SELECT 'a_loans' AS feed, 'read' AS reason, row_id, name FROM loaded"
    " UNION ALL SELECT 'b_loans', 'bytes that are not UTF-8', NULL, NULL"
    " UNION ALL SELECT 'c_loans', 'compressed file is cut or broken', NULL, NULL"
    " UNION ALL SELECT 'd_loans', 'quote left open', NULL, NULL",
)
def _(spark, sf):
    """One good feed; one with a part that has bad bytes after its header, one with a cut gzip part, one with an open quote.

    Runs jobs while the frame is built: the feeds are written, and read once.
    """
    folder = stage_path(spark, "feeds")
    raw = derived(spark, sf, RAW_LISTINGS).select(*_SHORT)
    for name in ("a_loans", "b_loans", "d_loans"):
        sinks.write_feed_csv(raw, folder, name, _STAMP)
    lines = F.array(F.lit("row_id,name,source"), F.lit("1,x,s"), F.concat(F.lit("2,"), F.unhex(F.lit("E9")).cast("string"), F.lit(",s")))
    bad = spark.range(1).coalesce(1).select(F.explode(lines).alias("value"))
    bad.write.mode("append").text(f"{folder}/b_loans_{_STAMP}.csv")
    lines = F.array(F.lit("row_id,name,source"), F.lit('1,"never closed,s'), F.lit("2,x,s"))
    spark.range(1).coalesce(1).select(F.explode(lines).alias("value")).write.mode("append").text(f"{folder}/d_loans_{_STAMP}.csv")
    whole = f"{folder}/whole"
    raw.write.options(header=True, compression="gzip").csv(whole)
    content = spark.read.format("binaryFile").load(feeds.parts(spark, whole)).select("content")
    cut = content.select(F.expr("substring(content, 1, length(content) - 40)").cast("string").alias("value"))
    cut.write.text(f"{folder}/c_loans_{_STAMP}.csv")
    for part in feeds.parts(spark, f"{folder}/c_loans_{_STAMP}.csv"):
        fs, path = feeds._fs(spark, part)
        fs.rename(path, path.suffix(".gz"))

    def feed(path):
        return F.regexp_extract(path, r"/(\w_loans)_[^/]*\.csv", 1).alias("feed")

    read = feeds.read_feeds(spark, feeds.discover(spark, folder, feeds.LOAN_NAMES))
    kept = read.table.select(feed("_file"), F.lit("read").alias("reason"), F.col("row_id").cast("long").alias("row_id"), "name")
    none = F.lit(None)
    left = read.rejected.select(feed("file"), "reason").distinct()
    return kept.unionByName(left.select("feed", "reason", none.cast("long").alias("row_id"), none.cast("string").alias("name")))


_WIDE = 700  # columns whose names of 100 characters make a header of 70 KB


@check("feed_wide_header", f"SELECT o_orderkey AS row_id, '{_WIDE + 1}' AS n_columns, o_custkey AS last FROM orders")
def _(spark, sf):
    cells = [F.col("o_custkey").alias(f"c{i:099d}") for i in range(_WIDE)]
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), *cells)
    folder = stage_path(spark, "feeds")
    # 5 KB a row as plain text; a compressed part is read as one cell, so its rows are bounded
    sinks.write_feed_csv(orders, folder, "a_loans", _STAMP, compression="gzip", maxRecordsPerFile=500_000)
    loaded = feeds.load_loan_feeds(spark, folder).drop(*feeds.LOAD_ORDER)
    return loaded.select(
        F.col("row_id").cast("long"), F.lit(str(len(loaded.columns))).alias("n_columns"),
        F.col(f"c{_WIDE - 1:099d}").cast("long").alias("last"),
    )
