"""Keep-first over staged rows, and records of several lines that Spark splits."""

from harrow.operators import dedup
from harrow.sources import record_tasks

SCHEMA = "name string, v string, _file string, _block long, _row long"


def _rows(chance):
    names = ["a", "b", None, "", "c"]
    return [(names[chance.randrange(5)], f"v{i}", f"f{i % 3}", (i * 7) % 5, i) for i in range(300)]


def test_staged_first_equals_first(spark):
    import random

    order = ["_file", "_block", "_row"]
    frame = spark.createDataFrame(_rows(random.Random(4)), SCHEMA).repartition(5)
    want = dedup.keep_first_by_name(frame, order, copies="n")
    got = dedup.keep_first_by_name(frame, order, copies="n", staged=True)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 5
    assert dedup.keep_first_by_name(frame.limit(0), order, copies="n", staged=True).count() == 0


def test_staged_first_sorts_no_rows(spark):
    frame = spark.createDataFrame([("a", "v", "f", 0, 1)], SCHEMA)
    plan = dedup.keep_first_by_name(frame, ["_file", "_block", "_row"], copies="n", staged=True)._jdf.queryExecution()
    assert "Aggregate" not in plan.executedPlan().toString()


def _kinds(lines):
    reader = record_tasks.Range("f", 0, unsplit=True)
    return [(row[4], row[6], row[7], row[8]) for line in lines for row in reader.line(line)]


def test_records_of_several_lines_are_left_to_spark():
    found = _kinds(["a,b", '"x', 'y","z"', '"p', '""q","r"', '"s\r', 't","u"'])
    assert found[0][0] == record_tasks.HEADER
    assert found[1] == (record_tasks.QUOTED, None, 2, '"x\ny","z"')
    assert found[2][:2] == (record_tasks.RECORD, ['p\n"q', "r"])
    assert found[3][:2] == (record_tasks.RECORD, ["s\r\nt", "u"])
