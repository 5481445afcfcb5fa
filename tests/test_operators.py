"""Row-set operators against brute force."""

import random

from pyspark.sql import functions as F

from harrow.operators import conform, dedup, filters, preview, report, union
from harrow.plans import clean
from harrow.schema import BANK, COMMON, LOAN_ORDER, SCHOLARSHIP_ORDER


def _listings(spark, rows):
    return spark.createDataFrame(rows, "row_id long, name string, source string, v string")


def _brute_first(rows, key):
    kept = {}
    for row in sorted(rows):
        kept.setdefault(key(row), row)
    return sorted(kept.values())


def _skewed_rows(n=3000):
    rng = random.Random(7)
    names = [None] * 40 + ["hot"] * 30 + [f"n{i}" for i in range(30)]  # two names hold most rows
    rows = [(i, rng.choice(names), rng.choice(["a", "b", None]), str(i)) for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_keep_first_matches_brute_force(spark):
    rows = _skewed_rows()
    df = _listings(spark, rows).repartition(7)
    got = dedup.keep_first_by_name(df, ["row_id"]).collect()
    assert sorted(tuple(r) for r in got) == _brute_first(rows, lambda r: r[1])
    got = dedup.keep_first_by_name_and_source(df, ["row_id"]).collect()
    assert sorted(tuple(r) for r in got) == _brute_first(rows, lambda r: r[1:3])
    got = dedup.keep_first_in_feed(df, ["row_id"]).collect()
    assert sorted(tuple(r) for r in got) == _brute_first(rows, lambda r: (r[2], r[1]))


def test_two_passes_equal_one(spark):
    df = _listings(spark, _skewed_rows())
    twice = dedup.keep_first_by_name(dedup.keep_first_by_name_and_source(df, ["row_id"]), ["row_id"])
    once = dedup.keep_first_by_name(df, ["row_id"])
    assert twice.exceptAll(once).isEmpty() and once.exceptAll(twice).isEmpty()


def test_copies_count_all_rows(spark):
    kept = dedup.keep_first_by_name(_listings(spark, _skewed_rows()), ["row_id"], copies="n")
    assert kept.agg(F.sum("n")).first()[0] == 3000


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = _listings(spark, _skewed_rows())
    for copies, reduced in (("n", "partial_min_by"), (None, "WindowGroupLimit [name")):
        plan = dedup.keep_first_by_name(df, ["row_id"], copies)._jdf.queryExecution().toString()
        physical = plan.split("== Physical Plan ==")[1]
        exchange = physical.index("Exchange hashpartitioning")
        assert physical.count("Exchange hashpartitioning") == 1
        assert physical.index(reduced, exchange) > exchange  # plans print from the result down
    assert "Partial" in physical[exchange:]


def test_conform(spark):
    df = spark.createDataFrame([("x", "k")], "name string, key_features string")
    loans = conform.conform_loans(df)
    assert set(loans.columns) == set(COMMON) | set(BANK) | {"key_features"}
    assert loans.first()["bank_code"] == "N/A"
    assert conform.conform_scholarships(df).columns == list(COMMON)
    ordered = conform.reorder_loans(loans).columns
    present = [c for c in LOAN_ORDER if c in loans.columns]
    assert ordered[:len(present)] == present and ordered[len(present):] == sorted(set(ordered) - set(present))
    assert conform.reorder_scholarships(conform.conform_scholarships(df)).columns == [
        c for c in SCHOLARSHIP_ORDER if c in COMMON
    ]


def test_name_from_product(spark):
    unnamed = spark.createDataFrame([(None, "p")], "name string, loan_product_name string")
    named = spark.createDataFrame([(None, "p"), ("n", "q")], "name string, loan_product_name string")
    assert conform.name_from_product(unnamed).first()["name"] == "p"
    assert {r["name"] for r in conform.name_from_product(named).collect()} == {None, "n"}


def test_gates_treat_null_apart(spark):
    df = spark.createDataFrame([(None, "s"), ("N/A", "s"), ("n", "N/A"), ("n", None), ("", "s")], "name string, source string")
    assert [r["name"] for r in filters.named(df).collect()] == [None, "n", "n", ""]
    assert [tuple(r) for r in filters.named_and_sourced(df).collect()] == [(None, "s"), ("n", None), ("", "s")]
    assert [r["name"] for r in filters.valid_name(df).collect()] == ["n", "n"]


def test_union_fills_missing(spark):
    a = spark.createDataFrame([("1", "2")], "x string, y string")
    b = spark.createDataFrame([("3", "4")], "z string, x string")
    got = {tuple(r) for r in union.union_feeds([a, b]).select("x", "y", "z").collect()}
    assert got == {("1", "2", None), ("4", None, "3")}


def test_preview_and_counts(spark):
    df = _listings(spark, [(3, "c", "s", "v"), (1, "a" * 70, "s", None), (2, "b", None, "v")])
    rows = preview.preview(df, [preview.short_name(F.col("name")).alias("n"), preview.elided(F.col("v")).alias("v")], ["row_id"], 2)
    assert [tuple(r) for r in rows.collect()] == [("a" * 65, "nan..."), ("b", "v...")]
    assert [tuple(r) for r in report.value_counts(df, "source").collect()] == [("s", 2)]
    assert [tuple(r) for r in report.count_by_first_seen(df, "source", ["row_id"]).collect()] == [("s", 2), (None, 1)]


def _raw(spark):
    columns = ("row_id", "name", "source", "description", "eligibility", "funding_amount", "contact", "deadline", "interest_rate")
    rows = [
        (1, "Grant A", "s1", "d", "e", "Rs. 5", "c", "1/2/2026", None),
        (2, "Grant A", "s2", "d", "e", "Rs. 6", "c", None, None),
        (3, " none ", "s1", None, None, None, None, None, None),
        (4, None, "s1", "bank", None, None, None, None, "5%"),
        (5, None, "s2", "bank", None, None, None, None, None),
        (6, "Grant A ", "s3", "d", None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'long' if c == 'row_id' else 'string'}" for c in columns))


def test_duplicates_go_before_cleaning(spark):
    """Duplicates go before text is cleaned: 'Grant A' and 'Grant A ' both stay;
    'none' turns into N/A after that and is dropped; one NULL name stays."""
    chain = clean.clean_loans(_raw(spark), ["row_id"])
    rows = {r["row_id"]: r for r in chain.table(keep_order=True).collect()}
    assert sorted(rows) == [1, 4, 6]
    assert rows[1]["name"] == rows[6]["name"] == "Grant A"
    assert rows[4]["loan_type"] == "Bank Loan" and rows[4]["interest_rate"] == "5%"
    assert rows[1]["data_quality_score"] == 100.0 and rows[4]["data_quality_score"] == 20.0


def test_stage_counts_and_report(spark):
    chain = clean.clean_loans(_raw(spark), ["row_id"])
    assert tuple(chain.stages().first()) == (6, 2, 4, 1, 3)
    got = {(r.section, r.metric): r.value for r in chain.report().collect()}
    assert got["rows", "original"] == 6 and got["rows", "cleaned"] == 3 and got["rows", "removal_rate"] == 50.0
    assert got["score", "median"] == 40.0 and got["score", "min"] == 20.0 and got["score", "max"] == 100.0
    assert got["band", "Poor"] == 1 and got["band", "Average"] == 1 and got["band", "Excellent"] == 1
    assert got["filled", "name"] == 3 and got["filled", "funding_amount"] == 1  # a NULL name counts as filled
    assert got["loan_type", "Bank Loan"] == 1 and got["source", "s1"] == 2 and ("source", "s2") not in got


def test_report_of_nothing(spark):
    chain = clean.clean_loans(_raw(spark).where("false"), ["row_id"])
    got = {(r.section, r.metric): r.value for r in chain.report().collect()}
    assert got.get(("rows", "removal_rate")) is None


def test_row_order_does_not_matter(spark):
    raw = _raw(spark)
    a = clean.clean_scholarships(raw, ["row_id"]).table()
    b = clean.clean_scholarships(raw.orderBy(F.desc("row_id")), ["row_id"]).table()
    assert a.exceptAll(b).isEmpty() and a.count() == b.count()


def test_clean_chain_plan(spark):
    """One shuffle, no Python."""
    plan = clean.clean_loans(_raw(spark), ["row_id"]).table()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan


def test_feed_quality_by_source(spark):
    rows = [("entries", "N/A"), ("entries", "text"), ("articles", ""), ("articles", "N/A"), (None, "")]
    got = report.feed_quality(spark.createDataFrame(rows, "source string, description string"),
                              by_source={"entries": {"description": "N/A"}})
    assert {r.source: (r.total, r.with_description) for r in got.collect()} == {"entries": (2, 1), "articles": (2, 1), None: (1, 0)}
