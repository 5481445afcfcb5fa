"""Column functions against hand-derived tables."""

import pytest
from pyspark.sql import functions as F

from harrow.functions import blocks, classify, extract, score, text

LONG = "x" * 501

CASES = {
    "amount": (extract.amount, [
        ("Rs. 10,000,000/-", "Rs. 10000000"),
        ("$2,500 then Rs 10", "Rs. 10"),
        ("scholars, see page", "Rs. "),
        ("50% of tuition fee", "50% of tuition fee"),
        ("  75% off ", "75% off"),
        ("LKR 5,000.50", "Rs. 5000.50"),
        ("lkr 7", "Rs. 7"),
        ("USD 12", "Rs. 12"),
        ("$9.999", "Rs. 9.99"),
        (" varies by year ", "varies by year"),
        (" to the maximum ", "to the maximum"),
        (" as is ", " as is "),
        ("", "N/A"),
        (None, "N/A"),
        ("N/A", "N/A"),
        (" N/A ", " N/A "),
    ]),
    "funding": (extract.funding, [(" to the maximum ", " to the maximum "), ("Rs.5", "Rs. 5")]),
    "period": (extract.period, [
        ("Maximum 7 years", "7 years"), ("60 months", "60 months"), ("24 EMI", "24 installments"),
        ("flexible ", "flexible"), ("12 months or 3 yrs", "3 years"), ("5 Mo", "5 months"), ("  ", "N/A"),
        ("36 installments", "36 installments"), (None, "N/A"),
    ]),
    "rate": (extract.rate, [
        ("12.5 % p.a.", "12.5%"), ("0%", "0%"), ("interest-free", "Interest-Free"), ("Zero rate", "Interest-Free"),
        ("Competitive ", "Competitive"), ("..%", "..%"), (None, "N/A"),
    ]),
    "age": (extract.age, [
        ("18 to 50", "18-50 years"), ("25 years or below", "25+ years"), ("18-65 years", "18-65 years"),
        ("between 20 and 30", "20-30 years"), ("any", "any"), ("30 YRS", "30+ years"),
    ]),
    "deadline": (extract.deadline, [
        ("by 31/12/2025 noon", "31/12/2025"), ("15 march 2026", "15 march 2026"), ("1 Feb 2026", "1 Feb 2026"),
        ("Within 6 weeks", "Within 6 weeks"), ("N/A - Ongoing", "Ongoing"), ("rolling basis", "Ongoing"),
        ("Monday", "Monday"), ("TBA", "TBA"), ("1-2-26 or 5 May 2026", "1-2-26"), ("", "N/A"),
    ]),
    "duration": (classify.duration_bucket, [
        ("3 years", "Short-term (≤3 years)"), ("7 years", "Medium-term (4-7 years)"),
        ("60 months", "Long-term (>7 years)"), ("N/A", "Unknown"), (None, "Unknown"),
        ("9" * 60, "Long-term (>7 years)"), ("٥ years", "Medium-term (4-7 years)"), ("१२ months", "Long-term (>7 years)"),
    ]),
    "strip": (text.strip, [(" \t a b 　\x1f", "a b"), (None, None), ("   ", "")]),
    "collapse": (text.collapse_spaces, [("a \n b\x1cc", "a b c"), ("a b", "a b")]),
    "null_like": (text.null_like, [("none", "N/A"), ("None", "N/A"), ("", "N/A"), (" ", " "), (None, None), ("x", "x")]),
    "clean": (text.clean_text, [
        ("  People\tFund  ", "People Fund"), ("<b>Aid</b> now", "Aid now"), ("<br>", ""), ("x <br>", "x "),
        ("n/a", "N/A"), ("  ", "N/A"), (None, None), ("a\n\nb", "a b"), ("a < b", "a < b"),
    ]),
    "eligibility": (text.clean_eligibility, [
        ("Must enroll\n \nPass", "Must enroll\nPass"), ("a\n\n\nb", "a\nb"), (LONG, "x" * 500 + "..."),
        ("x" * 500, "x" * 500), (None, "N/A"), ("N/A", "N/A"), ("  ", "N/A"), ("é" * 501, "é" * 500 + "..."),
    ]),
    "status": (lambda c: text.labelled_field(c, "Status:"), [
        ("Status: PhD | Subject area: Law", "PhD"), ("Status: | Graduates", ""), ("none", "N/A"),
        ("a Status: x Status: y", "x"),
    ]),
    "keyword_line": (text.keyword_line, [
        ("one\n  Closing soon  \ndeadline x", "Closing soon"), ("nothing", "N/A"),
        ("DEADLINE " + "y" * 200, "DEADLINE " + "y" * 91), (None, "N/A"),
    ]),
    "url": (lambda c: text.resolve_url(c, "https://s.org"), [
        ("http://a", "http://a"), ("/b", "https://s.org/b"), ("c", "N/A"), (None, "N/A"), ("", "N/A"),
    ]),
    "amount_rupee": (blocks.amount_rupee, [("pay Rs. 5,000 now", "Rs. 5,000"), ("USD 5", "N/A"), ("LKR7", "LKR7"), ("Rs 5", "N/A")]),
    "amount_mixed": (blocks.amount_mixed, [("$ 3,400 or Rs.20", "$ 3,400"), ("usd 5", "N/A"), ("USD 5", "USD 5")]),
    "date_text": (blocks.date_text, [
        ("on 1 May 2026 or 1/2/26", "1/2/26"), ("12 June 2026", "12 June 2026"), ("12 june 2026", "N/A"),
    ]),
    "article_funding": (blocks.article_funding, [
        ("The award: $ 2,000 each", "award: $ 2,000"), ("LKR 900", "LKR 900"), ("2500 USD", "500 USD"), ("none", "N/A"),
    ]),
    "article_deadline": (blocks.article_deadline, [
        ("Deadline: 5 May\nnext", "5 May"), ("deadline: " + "z" * 120 + "\nor 5/6/2026", "5/6/2026"),
        ("by 3  March\n2026", "3  March 2026"), ("closing date\t\n 9", "9"), ("deadline: soon", "soon"), ("x", "N/A"),
        ("Application   deadline: 1-2-26\r\n", "1-2-26"),
    ]),
    "article_contact": (blocks.article_contact, [
        ("Contact: a@b.c or call\nx", "a@b.c or call"), ("Email\n me", "me"), ("x", "N/A"),
        ("email " + "q" * 150, "q" * 100),
    ]),
    "entry_duration": (blocks.entry_duration, [
        ("3 years or 24 months", "24 month"), ("2 Years", "2 Year"), ("8mo", "8mo"), ("x", "N/A"),
    ]),
    "entry_funding": (blocks.entry_funding, [
        ("€ 934 and stipend", "€934 per month"), ("EUR 1,200 stipend", "N/A"), ("a Stipend", "Monthly stipend provided"),
        ("Fully funded", "Fully funded"), ("x", "N/A"),
    ]),
    "level": (classify.study_level, [
        ("PhD students", "Doctoral/PhD"), ("Master or Bachelor", "Master's"), ("Bachelors", "Bachelor's"),
        ("Undergraduates", "Graduate"), ("x", "N/A"),
    ]),
    "program": (classify.program_type, [
        ("Research study", "Research Grant"), ("Study", "Study Scholarship"), ("Summer school", "Summer Program"), ("x", "N/A"),
    ]),
    "tokens": (lambda c: text.null_tokens("t"), [("NA", None), ("none", "none"), ("-1.#IND", None), ("", None), ("x", "x"), ("null", None)]),
}


@pytest.mark.parametrize("name", CASES)
def test_table(apply, name):
    function, rows = CASES[name]
    got = apply(function, [r[0] for r in rows])
    assert got == [r[1] for r in rows]


LOANS = [
    ("Institute of Buddhist Academy", "x", "NSB Loan"), ("NSBM", None, "Bank Loan"), ("Daily help", "x", "DAI Related"),
    ("a", "by MOHE", "Government Loan"), ("b", "c", "Other"), (None, None, "Other"),
]


def test_loan_type(spark):
    rows = spark.createDataFrame(LOANS, "n string, d string, want string")
    got = rows.select(classify.loan_type(text.rule_text(F.col("n"), F.col("d"))).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_scholarship_rules(spark):
    rows = spark.createDataFrame([
        ("Exam award", "", "", "Merit-Based", "Unknown"), ("Low-income aid", "", "local", "Need-Based", "Local"),
        ("Sports", "abroad", "", "Talent-Based", "International"), ("Bursary", "both", "", "Grant/Bursary", "Both"),
        ("Mahapola", "", "Sri Lanka only", "Government", "Sri Lanka"), ("x", None, None, "General", "Unknown"),
    ], "n string, d string, e string, kind string, region string")
    n, d, e = F.col("n"), F.col("d"), F.col("e")
    got = rows.select(
        classify.scholarship_type(text.rule_text(n, d)), "kind", classify.eligible_region(text.rule_text(n, d, e)), "region"
    ).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in got)


def test_scores_and_bands(spark):
    columns = score.SCHOLARSHIP_FIELDS
    rows = [tuple("v" if i < n else ("N/A" if i % 2 else None) for i in range(6)) for n in range(7)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    got = df.select(score.quality_score(columns)).collect()
    assert [r[0] for r in got] == [0.0, 16.67, 33.33, 50.0, 66.67, 83.33, 100.0]
    blank = spark.createDataFrame([("",) * 6], df.schema).select(score.quality_score(columns)).first()[0]
    assert blank == 100.0
    bands = spark.createDataFrame([(80.0,), (79.9,), (60.0,), (40.0,), (39.9,)], "s double")
    got = [r[0] for r in bands.select(classify.quality_band(F.col("s"))).collect()]
    assert got == ["Excellent", "Good", "Good", "Average", "Poor"]


@pytest.mark.parametrize("function", [extract.amount, extract.period, extract.age, text.clean_eligibility])
def test_idempotent(apply, function):
    texts = ["Rs. 5,000/-", "7 yrs", "60 months", "18 to 50", "a\n\nb", "text", None, "N/A", ""]
    once = apply(function, texts)
    assert apply(function, once) == once


def test_join_lines(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(text.join_lines(F.col("a"), F.col("b"))).collect()]
    assert got == ["a\nb", "b", "N/A"]
