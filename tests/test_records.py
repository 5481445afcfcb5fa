"""Files to records: byte ranges, quoted cells over them, verdicts on files, one scan for all headers."""

import csv
import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from harrow.sources import feeds, records
from harrow.sources import record_tasks as tasks

CELLS = ["a", "b,c", 'd"e', "f\ng", 'h\n"i"\n,j', "", "é" * 3, "x y", '"', "\r\n", " "]


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def text_of(rows, **options):
    out = io.StringIO(newline="")
    csv.writer(out, **options).writerows(rows)
    return out.getvalue()


def cells_of(df, n):
    return [[c or "" for c in row[:n]] for row in df.orderBy(*feeds.LOAD_ORDER).collect()]


def test_line_ends_as_the_csv_module_reads_them():
    chance = random.Random(4)
    for _ in range(20_000):
        line = "".join(chance.choices('"",ab', k=chance.randint(0, 9)))
        for inside in (False, True):
            # a cell that is still open takes the next line in
            text = ('"x\n' if inside else "") + line + '\n"z'
            rows = list(csv.reader(io.StringIO(text, newline="")))
            want = len(rows) == 1
            assert tasks.ends_open(line, inside) == want, (line, inside)


def test_ranges_meet_or_not(spark):
    """Every cut of a text into ranges gives the records of the whole text."""
    chance = random.Random(2)
    for _ in range(40):
        rows = [[chance.choice(CELLS[:-2]) for _ in range(2)] for _ in range(chance.randint(1, 8))]
        text = text_of([["h", "i"], *rows], lineterminator="\n", quoting=chance.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL]))
        lines = text.removesuffix("\n").split("\n")
        cuts = sorted({0, *chance.choices(range(len(lines)), k=3)})
        state, got, held = False, [], []
        for start, end in zip(cuts, [*cuts[1:], len(lines)]):
            part = tasks.Range("f", start)
            found = [r for line in lines[start:end] for r in part.line(line)]
            found += part.end()
            own = [r for r in found if r[5] == tasks.BOTH or r[5] == (tasks.IN if state else tasks.OUT) or state and r[4] == tasks.LINE]
            for r in own:
                if r[4] == tasks.LINE and not (state and r[5] == tasks.OUT):
                    got += [r[8].split(",")] if r[8] else []
                elif r[4] in (tasks.RECORD, tasks.HEADER):
                    got.append(r[6])
                elif r[4] != tasks.RANGE:
                    held.append(r[8])
                    if r[4] == tasks.HEAD:
                        got += tasks.parse("\n".join(held))
                        held = []
            state = own[-1][10] if state else own[-1][9]
        assert not held and sorted(got) == sorted(list(csv.reader(io.StringIO(text, newline=""))))


def test_one_quoted_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    chance = random.Random(1)
    rows = [[str(i), *[chance.choice(CELLS) for _ in range(3)]] for i in range(700)]
    rows[300][1] = 'one cell over several ranges\n"' * 40
    for name, options in (("a", {}), ("b", {"quoting": csv.QUOTE_ALL, "lineterminator": "\n"})):
        (tmp_path / f"{name}_loans.csv").write_text(text_of([["id", "b", "c", "d"], *rows], **options), encoding="utf-8", newline="")
    for name in ("a", "b"):
        df = feeds.read_feed_files(spark, [f"file:{tmp_path}/{name}_loans.csv"])
        assert df.select("_block").distinct().count() > 20
        got = cells_of(df, 4)
        assert got == [r if any(r) else r for r in rows]


def test_header_over_several_ranges(spark, tmp_path, small_ranges):
    names = [f"column {i}\nwith a second line" for i in range(60)]
    text = "\n\r\n" + text_of([names, *[[str(i)] * 60 for i in range(20)]])
    (tmp_path / "a_loans.csv").write_text("﻿" + text, encoding="utf-8", newline="")
    df = feeds.read_feed_files(spark, [f"file:{tmp_path}/a_loans.csv"])
    assert df.columns[:60] == names and [r[0] for r in cells_of(df, 1)] == [str(i) for i in range(20)]


def test_files_that_cannot_be_read_to_their_end(spark, tmp_path, small_ranges):
    many = text_of([["name", "source"], *[[f"row {i}", "s"] for i in range(200)]])
    (tmp_path / "good loan.csv").write_text(many, newline="")
    (tmp_path / "bytes_loan.csv").write_bytes(many.encode() + b"caf\xe9,s\n" + b"x,s\n" * 9)
    (tmp_path / "open_loan.csv").write_text(many + 'x,"never closed\n' + "y,s\n" * 99, newline="")
    (tmp_path / "ragged_loan.csv").write_text(many + "x,s,t\n", newline="")
    (tmp_path / "empty_loan.csv").write_text("\n\n")
    whole = gzip.compress(many.encode())
    for name, parts in (("cut", [whole[:-20], whole]), ("broken", [whole, b"no gzip"]), ("packed", [whole, whole + whole, gzip.compress(b"")])):
        (tmp_path / f"{name}_loan.csv").mkdir()
        for i, content in enumerate(parts):
            (tmp_path / f"{name}_loan.csv" / f"part-{i}.csv.gz").write_bytes(content)
    paths = feeds.discover(spark, str(tmp_path), feeds.LOAN_NAMES)
    assert len(paths) == 12
    read = feeds.read_feeds(spark, paths)
    reasons = {r["file"].removeprefix(f"file:{tmp_path}/"): r["reason"] for r in read.rejected.collect()}
    assert reasons == {
        "bytes_loan.csv": tasks.NOT_TEXT, "open_loan.csv": records.QUOTE_OPEN, "ragged_loan.csv": records.RAGGED,
        "empty_loan.csv": records.NO_HEADER, "cut_loan.csv/part-0.csv.gz": tasks.CUT, "cut_loan.csv/part-1.csv.gz": tasks.CUT,
        "broken_loan.csv/part-0.csv.gz": tasks.CUT, "broken_loan.csv/part-1.csv.gz": tasks.CUT, "packed_loan.csv/part-2.csv.gz": records.NO_HEADER,
    }
    counts = {r["_file"].split("/")[-1]: r["count"] for r in read.table.groupBy("_file").count().collect()}
    # two members of one gzip file are its text twice, the second header a row
    assert counts == {"good loan.csv": 200, "part-0.csv.gz": 200, "part-1.csv.gz": 401}


def test_many_headers_are_one_scan(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"f{i:03d}_loan.csv").write_text(f"name,c{i},source\nn{i},v{i},s\n")
    read = feeds.read_feeds(spark, feeds.discover(spark, str(tmp_path), feeds.LOAN_NAMES))
    assert len(read.table.columns) == 202 + len(feeds.LOAD_ORDER)
    plan = read.table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 6 and "Union" not in plan  # lines, ranges, and what is known of files
    rows = {r["name"]: r.asDict() for r in read.table.collect()}
    assert all(rows[f"n{i}"][f"c{i}"] == f"v{i}" and rows[f"n{i}"]["source"] == "s" for i in range(200))
    assert all(sum(v is not None for v in r.values()) == 3 + len(feeds.LOAD_ORDER) for r in rows.values())


def test_lines_end_in_three_ways(spark, tmp_path):
    for i, end in enumerate(("\n", "\r\n", "\r")):
        (tmp_path / f"f{i}_loan.csv").write_text(f'name,source{end}"a{end}b",s{end}{end}c,d', newline="")
    df = feeds.read_feed_files(spark, feeds.discover(spark, str(tmp_path), feeds.LOAN_NAMES))
    assert cells_of(df, 2) == [[x, y] for end in ("\n", "\r\n", "\r") for x, y in ((f"a{end}b", "s"), ("c", "d"))]


def test_nothing_to_read(spark, tmp_path):
    assert feeds.read_feed_files(spark, []) is None and feeds.rejected_files(spark, []).isEmpty()
    (tmp_path / "a_loan.csv").write_text("")
    read = feeds.read_feeds(spark, feeds.discover(spark, str(tmp_path), feeds.LOAN_NAMES))
    assert read.table is None and [r["reason"] for r in read.rejected.collect()] == [records.NO_HEADER]
    (tmp_path / "b_loan.csv").write_text("name,source\n")
    read = feeds.read_feeds(spark, feeds.discover(spark, str(tmp_path), feeds.LOAN_NAMES))
    assert read.table.columns == ["name", "source", *feeds.LOAD_ORDER] and read.table.isEmpty()
    assert read.table.select(F.max("name")).first()[0] is None


def test_quoted_records_are_split_as_the_csv_module_reads_them(spark, tmp_path):
    chance = random.Random(6)
    texts = ["".join(chance.choices('"",,ab', k=chance.randint(0, 12))) for _ in range(20_000)]
    texts += [f'"{t}"' for t in texts] + [",".join(f'"{c}"' for c in t) for t in texts[:2000] if t]
    plain = 0
    for text in texts:
        width = tasks.quoted_width(text)
        if width is not None:
            plain += 1
            cells = text[1:-1].split('","')
            assert [cells] == list(csv.reader([text])) and width == tasks.width(cells), text
    assert plain > 2000
    rows = [[str(i), chance.choice(["", "a,b", ",", "é\r", "x"]), chance.choice(["", ",,", "y"])] for i in range(200)]
    (tmp_path / "q_loan.csv").write_text(text_of([["i", "a", "b"], *rows], quoting=csv.QUOTE_ALL), newline="")
    read = feeds.load_loan_feeds(spark, str(tmp_path))
    assert sorted(cells_of(read, 3)) == sorted(rows)


def test_rows_of_feeds_are_not_shuffled(spark, tmp_path):
    """By file they would be, cells of all columns included, and a large file would go through one task."""
    (tmp_path / "a_loan.csv").write_text("name,source\nA,B\n")
    (tmp_path / "b_loan.csv").write_text("source,other\nC,D\n")
    read = feeds.load_loan_feeds(spark, str(tmp_path))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(file" not in plan
    assert {tuple(r)[:3] for r in read.collect()} == {("A", "B", None), (None, "C", "D")}
