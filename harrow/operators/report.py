"""Data quality figures of cleaned and merged tables."""

from pyspark.sql import functions as F

from harrow.functions.classify import quality_band
from harrow.functions.text import not_na_literal

# --- fixed values -----------------------------------------------------------
LOAN_BREAKDOWNS = ("loan_type", "loan_duration_category", "source")
SCHOLARSHIP_BREAKDOWNS = ("scholarship_type", "eligible_region", "source")
LOAN_COMPLETENESS = ("name", "description", "eligibility", "funding_amount", "interest_rate")
SCHOLARSHIP_COMPLETENESS = ("name", "description", "eligibility", "funding_amount", "deadline", "contact")
BANDS = ("Excellent", "Good", "Average", "Poor")
# ----------------------------------------------------------------------------


def percent(part, whole):
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def removal_summary(original, cleaned):
    """Original, cleaned, removed, removal rate, from two one-row counts."""
    counts = original.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("m")).unionByName(
        cleaned.agg(F.lit(0).cast("long").alias("n"), F.count(F.lit(1)).alias("m"))
    )
    n, m = F.sum("n"), F.sum("m")
    return counts.agg(
        n.alias("original"), m.alias("cleaned"), (n - m).alias("removed"), percent(n - m, n).alias("removal_rate")
    )


def score_stats(df, score="data_quality_score"):
    s = F.col(score)
    return df.agg(
        F.round(F.avg(s), 2).alias("mean_score"),
        F.round(F.median(s), 2).alias("median_score"),
        F.min(s).alias("min_score"),
        F.max(s).alias("max_score"),
    )


def band_counts(df, score="data_quality_score"):
    band = quality_band(F.col(score))
    return df.agg(*[F.count_if(band == b).alias(b.lower()) for b in BANDS])


def value_counts(df, column, limit=None):
    """Rows per value, most frequent first, ties by value; NULL is not counted."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.orderBy(F.desc("n"), column)
    return counts.limit(limit) if limit else counts


def completeness(df, fields):
    """Per field: rows that are not the literal N/A (NULL counts as filled)."""
    total = F.count(F.lit(1))
    cells = [
        F.struct(F.lit(f).alias("field"), F.count_if(not_na_literal(F.col(f))).alias("filled"), total.alias("total"))
        for f in fields
    ]
    wide = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    return wide.withColumn("filled_percent", percent(F.col("filled"), F.col("total")))


def merge_summary(df):
    """Totals of a merged table. A NULL counts as filled, and so does a column
    that no feed has."""

    def filled(name, blank):
        c = F.col(name) if name in df.columns else F.lit(None).cast("string")
        return F.count_if(~c.eqNullSafe(F.lit(blank)))

    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct("source").alias("sources"),
        filled("funding_amount", "N/A").alias("with_amount"),
        filled("deadline", "N/A").alias("with_deadline"),
        filled("description", "").alias("with_description"),
    )


def count_by_first_seen(df, column, order):
    """Rows per value, in the order in which the values first appear."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("_at"))
        .orderBy("_at")
        .select(column, "n")
    )


# field -> cell text that means "not filled" in a harvested feed
FEED_FIELDS = {
    "funding_amount": "N/A",
    "deadline": "N/A",
    "eligibility": "N/A",
    "description": "",
    "subject_area": "N/A",
}


def feed_quality(df, fields=FEED_FIELDS, by_source=None):
    """Filled counts per feed over the fields the frame has.

    by_source names the blank texts of feeds that mark a field in their own way:
    source -> {field: blank}.
    """
    own = {}
    for source, blanks in (by_source or {}).items():
        for field, blank in blanks.items():
            own.setdefault(field, []).append((source, blank))

    def blank_of(field):
        blank = F.lit(fields[field])
        for source, text in own.get(field, ()):
            blank = F.when(F.col("source").eqNullSafe(source), F.lit(text)).otherwise(blank)
        return blank

    filled = [F.count_if(~F.col(f).eqNullSafe(blank_of(f))).alias(f"with_{f}") for f in fields if f in df.columns]
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("total"), *filled)


def stage_counts(deduped, keep, copies="_copies"):
    """Rows per stage in one pass over a keep-first result that carries its
    copy counts; ``keep`` is the row filter that follows."""
    n, kept = F.count(F.lit(1)), F.count_if(keep)
    loaded = F.sum(copies)
    return deduped.agg(
        loaded.alias("loaded"),
        (loaded - n).alias("removed_duplicates"),
        n.alias("after_dedup"),
        (n - kept).alias("removed_unnamed"),
        kept.alias("after_filter"),
    )


def quality_report(scored, keep, breakdowns, fields, copies="_copies", score="data_quality_score"):
    """The whole report as one long table ``(section, metric, value)``.

    ``scored`` is the chain up to its scores and classes, before the row filter
    ``keep`` and with copy counts. One pass boils it down to counts per
    combination of the reported values; grouping sets over these few rows then
    give the overall figures and the counts per breakdown together.
    """
    flags = {f"has_{f}": not_na_literal(F.col(f)) for f in fields}
    cube = (
        scored.select(
            *breakdowns, F.col(score).alias("score"), keep.alias("kept"), F.col(copies).alias("c"),
            *[v.alias(k) for k, v in flags.items()],
        )
        .groupBy("kept", *breakdowns, "score", *flags)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("loaded"))
        .withColumns({"n": F.expr("if(kept, n, 0L)"), "s": F.expr("if(kept, score, NULL)")})
        .withColumn("band", quality_band(F.col("s")))
    )
    total, loaded = F.sum("n"), F.sum("loaded")
    figures = {
        ("rows", "original"): loaded,
        ("rows", "cleaned"): total,
        ("rows", "removed"): loaded - total,
        ("rows", "removal_rate"): percent(loaded - total, loaded),
        ("score", "mean"): F.round(F.try_divide(F.sum(F.col("s") * F.col("n")), total), 2),
        ("score", "median"): F.round(F.percentile("s", F.lit(0.5), F.col("n")), 2),
        ("score", "min"): F.min("s"),
        ("score", "max"): F.max("s"),
    }
    for band in BANDS:
        figures["band", band] = F.expr(f"sum(if(band = '{band}', n, 0L))")
    for f in fields:
        filled = F.expr(f"sum(if(has_{f}, n, 0L))")
        figures["filled", f] = filled
        figures["filled_percent", f] = percent(filled, total)
    sets = [[], *[[b] for b in breakdowns]]
    rolled = cube.groupingSets(sets, *breakdowns).agg(
        F.grouping_id().alias("grouping"),
        total.alias("n"),
        *[v.cast("double").alias(f"f{i}") for i, v in enumerate(figures.values())],
    )
    overall = F.expr("array(" + ", ".join(
        f"named_struct('section', '{section}', 'metric', '{metric}', 'value', f{i})"
        for i, (section, metric) in enumerate(figures)
    ) + ")")
    everything = 2 ** len(breakdowns) - 1
    # a set of one breakdown leaves that column's bit unset in the grouping id
    cells = F.when(F.col("grouping") == everything, overall)
    for i, b in enumerate(breakdowns):
        mine = everything - 2 ** (len(breakdowns) - 1 - i)
        cell = F.expr(f"array(named_struct('section', '{b}', 'metric', `{b}`, 'value', double(n)))")
        cells = cells.when((F.col("grouping") == mine) & F.col(b).isNotNull() & (F.col("n") > 0), cell)
    return rolled.select(F.inline(cells))
