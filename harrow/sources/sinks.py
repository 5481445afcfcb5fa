"""Writers: cleaned tables, feeds, merged buffers and reports."""

from pyspark.sql import functions as F

# quoting that reads back to the same cells
_CSV = {
    "header": True,
    "escape": '"',
    "quoteAll": True,
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
}

SECTIONS = ("rows", "score", "band")


def write_csv(df, path, **options):
    df.write.mode("overwrite").options(**_CSV, **options).csv(path)
    return path


def write_cleaned(df, folder, name, stamp):
    """Stable copy and dated copy. ``df`` should be a staged table, as it is
    read twice."""
    stable = write_csv(df, f"{folder}/{name}.csv")
    write_csv(df, f"{folder}/{name}_{stamp}.csv")
    return stable


def write_feed_csv(df, folder, name, stamp, **options):
    """One feed as CSV, with further options of the writer such as ``compression``; an empty feed writes nothing and
    gives None."""
    if df.isEmpty():
        return None
    return write_csv(df, f"{folder}/{name}_{stamp}.csv", **options)


def write_feed_json(df, folder, name, stamp):
    """One feed as JSON lines, non-ASCII as is, a cell without value left out."""
    if df.isEmpty():
        return None
    path = f"{folder}/{name}_{stamp}.json"
    df.write.mode("overwrite").json(path)
    return path


def write_merged(deduped, buffer, folder, stamp, name="all_scholarships"):
    """CSV of the deduplicated table, JSON of the whole buffer."""
    write_csv(deduped, f"{folder}/{name}_{stamp}.csv")
    buffer.write.mode("overwrite").json(f"{folder}/{name}_{stamp}.json")


def write_report(report, folder, name, stamp):
    """Report lines ``section | metric | value``, figures first, then counts
    per value from the most frequent down. Counts are whole numbers, rates and
    scores have two decimals."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.col("section")), F.lit(0))
    ordered = report.select("*", F.when(rank > 0, rank).otherwise(len(SECTIONS) + 1).alias("rank")).orderBy(
        "rank", "section", F.desc("value"), "metric"
    )
    fraction = F.col("section").isin("score", "filled_percent") | (F.col("metric") == "removal_rate")
    value = F.when(fraction, F.format_string("%.2f", "value")).otherwise(F.format_string("%.0f", "value"))
    path = f"{folder}/{name}_cleaning_report_{stamp}.txt"
    ordered.select(F.concat_ws(" | ", "section", "metric", value).alias("value")).write.mode("overwrite").text(path)
    return path
