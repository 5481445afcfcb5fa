"""Feed files in, tables and reports out, ingest and merge."""

import glob
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

import seeds
from harrow import session
from harrow.operators import dedup, expand, union
from harrow.plans import clean, merge, runs
from harrow.schema import COMMON, string_schema
from harrow.sources import feeds, sinks

STAMP = "20260101_000000"


def _write(folder, name, text, **options):
    path = folder / name
    path.write_text(text, encoding="utf-8", newline="", **options)
    return path


def _read(path):
    """All parts of a written CSV, read back with the engine's own reader."""
    return sorted(glob.glob(f"{path}/part-*"))


def _cells(df):
    return [tuple(r) for r in df.orderBy(*feeds.LOAD_ORDER).drop(*feeds.LOAD_ORDER).collect()]


def test_discovery(spark, tmp_path):
    for name in ("b_loans.csv", "a_DAI.csv", "institutions.csv", "loan_scholarship.csv", "x_scholarships.csv",
                 "loans.CSV", "loans.txt", "loans_cleaned.csv", "other.csv"):
        _write(tmp_path, name, "name\nx\n")
    (tmp_path / "dir_loans.csv").mkdir()
    _write(tmp_path / "dir_loans.csv", "part-00000.csv", "name\ny\n")
    _write(tmp_path / "dir_loans.csv", "_SUCCESS", "")

    def names(rule, **options):
        return [p.split("/")[-1] for p in feeds.discover(spark, str(tmp_path), rule, **options)]

    assert names(feeds.LOAN_NAMES) == ["a_DAI.csv", "b_loans.csv", "part-00000.csv", "institutions.csv", "loans_cleaned.csv"]
    assert "loans_cleaned.csv" not in names(feeds.LOAN_NAMES, exclude_outputs=True)
    assert names(feeds.SCHOLARSHIP_NAMES) == ["x_scholarships.csv"]
    assert feeds.load_loan_feeds(spark, str(tmp_path / "absent")) is None


def test_read_mixed_headers_in_load_order(spark, tmp_path):
    _write(tmp_path, "b_loan.csv", 'name,source\n"multi\nline, ""q""",s\nN/A,none\n')
    _write(tmp_path, "a_loan.csv", "﻿source,x.y,name\ns2,1,first\n,-nan,second\n")
    _write(tmp_path, "c_loan.csv", "name,source\nshort\nlast,s\n")
    df = feeds.load_loan_feeds(spark, str(tmp_path))
    rows = [r.asDict() for r in df.orderBy(*feeds.LOAD_ORDER).collect()]
    got = [(r["name"], r["source"], r["x.y"]) for r in rows]
    assert got == [
        ("first", "s2", "1"), ("second", None, None), ('multi\nline, "q"', "s", None), (None, "none", None),
        ("short", None, None), ("last", "s", None),
    ]


def test_bad_files_are_left_out(spark, tmp_path):
    _write(tmp_path, "a_loan.csv", "name,source\ngood,s\n")
    _write(tmp_path, "b_loan.csv", "name,source\nfine,s\ntoo,many,cells\n")
    _write(tmp_path, "c_loan.csv", "")
    (tmp_path / "d_loan.csv").write_bytes(b"na\xffme,source\nx,s\n")
    assert _cells(feeds.load_loan_feeds(spark, str(tmp_path))) == [("good", "s")]
    kept = feeds.load_loan_feeds(spark, str(tmp_path), skip_ragged=False)
    assert [r[0] for r in _cells(kept)] == ["good", "fine", "too"]


def test_repeated_and_blank_column_names(spark, tmp_path):
    _write(tmp_path, "a_loan.csv", "name,name,\n1,2,3\n")
    row = feeds.load_loan_feeds(spark, str(tmp_path)).first().asDict()
    assert (row["name"], row["name.1"], row["Unnamed: 2"]) == ("1", "2", "3")


def test_csv_round_trip(spark, tmp_path):
    cells = [(" edge ", 'q"uote', "line\nbreak"), ("", None, "é€"), ("a,b", "\\", "tab\t")]
    df = spark.createDataFrame(cells, "name string, source string, v string").coalesce(1)
    sinks.write_csv(df, str(tmp_path / "x_loans.csv"))
    got = _cells(feeds.load_loan_feeds(spark, str(tmp_path)))
    assert got == [tuple(c or None for c in row) for row in cells]


def test_feed_sinks(spark, tmp_path):
    df = spark.createDataFrame([("ñ", None), ("b", "x")], "name string, v string").coalesce(1)
    assert sinks.write_feed_csv(df.where("false"), str(tmp_path), "f", STAMP) is None
    assert sinks.write_feed_json(df.where("false"), str(tmp_path), "f", STAMP) is None
    path = sinks.write_feed_json(df, str(tmp_path), "f", STAMP)
    lines = [json.loads(line) for part in _read(path) for line in open(part, encoding="utf-8")]
    assert path.endswith(f"f_{STAMP}.json") and lines == [{"name": "ñ"}, {"name": "b", "v": "x"}]


def _scheme(spark):
    """The loan-scheme feed: a scheme row plus two expanded dimensions."""
    scheme = spark.createDataFrame([{**seeds.SCHEME, **seeds.PLACE, "ord": 0}])
    institutes = spark.createDataFrame([(i + 1, c, t) for i, (c, t) in enumerate(seeds.INSTITUTES)], "ord long, code string, title string")
    programs = spark.createDataFrame([(i + 100, s, a) for i, (s, a) in enumerate(seeds.PROGRAMS)], "ord long, stream string, amount string")
    expanded = [
        expand.expand_dimension(institutes, seeds.INSTITUTE_TEMPLATES, {**seeds.INSTITUTE_CONSTANTS, **seeds.PLACE}, ["ord"]),
        expand.expand_dimension(programs, seeds.PROGRAM_TEMPLATES, {**seeds.PROGRAM_CONSTANTS, **seeds.PLACE}, ["ord"]),
    ]
    feed = union.union_feeds([scheme.select(*COMMON, "ord"), *expanded])
    return dedup.keep_first_in_feed(feed, ["ord"])


def test_loan_scheme_end_to_end(spark, tmp_path):
    """31 feed rows through files into the cleaned table."""
    feed = _scheme(spark).orderBy("ord")
    assert feed.count() == 31
    sinks.write_feed_csv(feed.drop("ord"), str(tmp_path), "student_loans", STAMP)
    out = str(tmp_path / "out")
    stable = runs.clean_loan_folder(spark, str(tmp_path), out, stamp=STAMP)
    assert stable == f"{out}/loans_cleaned.csv"
    table = feeds.read_feed_files(spark, _read(stable)).drop(*feeds.LOAD_ORDER)
    dated = feeds.read_feed_files(spark, _read(f"{out}/loans_cleaned_{STAMP}.csv")).drop(*feeds.LOAD_ORDER)
    assert table.exceptAll(dated).isEmpty()
    rows = [r.asDict() for r in table.collect()]
    assert len(rows) == 31 and len(rows[0]) == 26
    assert Counter(r["loan_type"] for r in rows) == seeds.EXPECTED_TYPES
    assert Counter(r["funding_amount"] for r in rows) == seeds.EXPECTED_AMOUNTS
    assert {r["loan_duration_category"] for r in rows} == {"Unknown"}
    assert {r["data_quality_score"] for r in rows} == {"100.0"}
    by_name = {r["name"]: r for r in rows}
    scheme = by_name["Interest-Free Student Loan Scheme"]
    assert len(scheme["eligibility"]) == 503 and scheme["eligibility"].endswith("...")
    assert scheme["deadline"] == "N/A - Ongoing scheme"
    assert by_name["Approved DAI: National School of Business Management"]["loan_type"] == "Bank Loan"
    assert by_name["Approved DAI: Sri Lanka Institute of Buddhist Academy"]["loan_type"] == "NSB Loan"
    report = "".join(open(p, encoding="utf-8").read() for p in _read(f"{out}/loans_cleaning_report_{STAMP}.txt"))
    lines = report.splitlines()
    assert lines[0].startswith("rows | ") and "rows | cleaned | 31" in lines and "loan_type | Other | 14" in lines


def test_scholarship_folder(spark, tmp_path):
    _write(tmp_path, "x_scholarships_1.csv", "name,source,extra,deadline\nGrant,s,q,by 1/2/2026\nnone,s,q,\n,s,q,\n,s,q,\n")
    out = str(tmp_path / "out")
    stable = runs.clean_scholarship_folder(spark, str(tmp_path), out, stamp=STAMP)
    rows = [r.asDict() for r in feeds.read_feed_files(spark, _read(stable)).collect()]
    assert sorted((r["name"] or "", r["deadline"] or "") for r in rows) == [("", ""), ("Grant", "1/2/2026")]
    assert "extra" not in rows[0]
    assert runs.clean_scholarship_folder(spark, str(tmp_path / "none"), out) is None


def _stages(spark):
    return set(glob.glob(f"{session.stage_dir(spark).removeprefix('file:')}/*"))


def test_stages_end_with_their_run(spark, tmp_path):
    _write(tmp_path, "x_scholarships_1.csv", "name,source\nGrant,s\n")
    _write(tmp_path, "x_loans_1.csv", "name,source\nLoan,s\n")
    before = _stages(spark)
    assert runs.clean_loan_folder(spark, str(tmp_path), str(tmp_path / "out")) and runs.clean_scholarship_folder(
        spark, str(tmp_path), str(tmp_path / "out"))
    assert _stages(spark) == before
    with pytest.raises(RuntimeError), session.stage_scope(spark):
        merged = merge.ingest(spark, [merge.Feed("one", _feed([(1, "a", "s1", "")])), merge.Feed("late", _late_failure)], ["ord"])
        assert merged.table.count() == 1 and _stages(spark) > before
        raise RuntimeError("stop")
    assert _stages(spark) == before


def _feed(rows):
    return lambda spark: spark.createDataFrame(rows, "ord long, name string, source string, description string")


def _late_failure(spark):
    bad = spark.range(100).select(F.col("id").alias("ord"), F.expr("if(id = 99, raise_error('late'), 'n')").alias("name"))
    return bad.withColumn("source", F.lit("bad"))


def test_ingest_isolates_feeds(spark):
    def broken(spark):
        raise RuntimeError("down")

    registry = [
        merge.Feed("one", _feed([(1, "a", "s1", ""), (2, "a", "s1", "x"), (3, None, "s2", None), (4, None, "s3", None)])),
        merge.Feed("broken", broken),
        merge.Feed("late", _late_failure),
        merge.Feed("empty", _feed([])),
        merge.Feed("two", lambda s: s.createDataFrame([(1, "a", "s1", "z")], "ord long, name string, source string, amount string")),
    ]
    merged = merge.ingest(spark, registry, ["ord"])
    assert merged.failed == ("broken", "late")
    assert merged.buffer.count() == 5
    rows = sorted((r["name"] or "", r["source"], r["description"] or "") for r in merged.table.collect())
    assert rows == [("", "s2", ""), ("", "s3", ""), ("a", "s1", "")]
    assert merge.ingest(spark, [registry[1], registry[3]], ["ord"]) is None


def test_ingest_writes_feeds_and_merge(spark, tmp_path):
    rows = [tuple(f"{c}{i % 2}" for c in COMMON) + (i,) for i in range(4)]
    schema = ", ".join(f"{c} string" for c in COMMON) + ", ord long"
    registry = [merge.Feed("x_scholarships", lambda s: s.createDataFrame(rows, schema))]
    merged = merge.ingest(spark, registry, ["ord"], str(tmp_path), STAMP)
    assert merged.table.count() == 2
    assert merged.summary.first()["total"] == 2 and merged.summary.first()["sources"] == 2
    buffer = spark.read.json(f"{tmp_path}/all_scholarships_{STAMP}.json")
    assert buffer.count() == 4 and sorted(buffer.columns) == sorted(COMMON)
    table = feeds.load_scholarship_feeds(spark, str(tmp_path))
    assert table.count() == 4 + 2  # the feed's own file and the merged file


def test_stream_equals_batch(spark, tmp_path):
    from harrow.streaming.rowwise import clean_loan_rows

    columns = ("name", "source", "funding_amount", "repayment_period")
    batch = spark.createDataFrame([("A", "s", "Rs. 5/-", "7 yrs"), ("none", "s", None, None)], string_schema(columns))
    batch.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    query = (
        clean_loan_rows(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = clean_loan_rows(batch)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and got.count() == want.count() == 1


def test_scholarship_rows_on_a_stream_plan(spark, tmp_path):
    from harrow.streaming.rowwise import clean_scholarship_rows

    batch = spark.createDataFrame([("A", "s", "by 1/2/2026"), ("A", "N/A", "x")], "name string, source string, deadline string")
    batch.write.parquet(str(tmp_path / "in"))
    rows = clean_scholarship_rows(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in")))
    assert rows.isStreaming and rows.columns == clean_scholarship_rows(batch).columns
    # a source of N/A reads as NULL, and a NULL source passes
    assert {(r["source"], r["deadline"]) for r in clean_scholarship_rows(batch).collect()} == {("s", "1/2/2026"), (None, "x")}


@pytest.mark.parametrize("fallback, names", [(False, 1), (True, 3)])
def test_bank_rows_collapse_unless_asked(spark, fallback, names):
    rows = [(i, f"bank {i}", f"product {i}", "s") for i in range(3)]
    raw = spark.createDataFrame(rows, "ord long, bank_name string, loan_product_name string, source string")
    raw = raw.withColumn("name", F.lit(None).cast("string"))
    assert clean.clean_loans(raw, ["ord"], alias_fallback=fallback).table().count() == names


def test_long_header_and_rejected_files(spark, tmp_path):
    names = ["name", "source", *[f'"column ""{i}""\n with a long name"' for i in range(4000)]]
    folder = tmp_path / "wide"
    folder.mkdir()
    (folder / "wide_loan.csv").write_text(",".join(names) + "\nLoan,S" + ",x" * 4000 + "\n")
    (folder / "good_loan.csv").write_text("name,source\nA,B\n")
    (folder / "ragged_loan.csv").write_text("name,source\nA,B\nC,D,E\n")
    (folder / "empty_loan.csv").write_text("")
    paths = feeds.discover(spark, str(folder), feeds.LOAN_NAMES)
    read = feeds.read_feed_files(spark, paths)
    assert len(read.columns) == 4002 + len(feeds.LOAD_ORDER)
    assert sorted(r.name for r in read.select("name").collect()) == ["A", "Loan"]
    rejected = {r.file.rsplit("/", 1)[-1]: r.reason for r in feeds.rejected_files(spark, paths).collect()}
    assert rejected == {"ragged_loan.csv": "row longer than header", "empty_loan.csv": "no header"}
