import csv
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from cartwise.sources import files, quoted

COLUMNS = ("id", "a", "b c", "d")
SCHEMA = T.StructType([T.StructField("id", T.LongType()), *(T.StructField(c, T.StringType()) for c in COLUMNS[1:])])
PIECES = ["x", "\n", "\n\n", '"', '""', ",", "é", " ", "5\" pipe", "\r\n", "end"]


def table(n, seed):
    own = random.Random(seed)
    return [(i, *("".join(own.choices(PIECES, k=own.randrange(5))) for _ in range(3))) for i in range(n)]


def write(path, rows, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(COLUMNS)
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())


@pytest.mark.parametrize("size", [150, 1000, 10**6])
def test_same_as_one_task_per_file(spark, tmp_path, size):
    write(tmp_path / "a.csv", table(300, 1))
    write(tmp_path / "b.csv", table(200, 2), "\r\n")
    write(tmp_path / "c.csv", [])
    whole, _ = files.read_csv(spark, str(tmp_path), SCHEMA, missing_tokens=(), multi_line=True)
    want = sorted(map(tuple, whole.collect()), key=repr)
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.set(name, str(size))
    try:
        parts, bad = files.read_csv(spark, str(tmp_path), SCHEMA, missing_tokens=(), multi_line="parallel")
        assert sorted(map(tuple, parts.collect()), key=repr) == want and bad.count() == 0 and len(want) == 500
        if size < 1000:
            assert quoted.lines_of(spark, str(tmp_path)).rdd.getNumPartitions() > 10
    finally:
        for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.unset(name)


def test_many_parts_are_dealt_out_instead(spark, tmp_path, monkeypatch):
    write(tmp_path / "a.csv", table(200, 5))
    whole, _ = files.read_csv(spark, str(tmp_path), SCHEMA, missing_tokens=(), multi_line=True)
    monkeypatch.setattr(quoted, "BROADCAST_PARTS", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        parts, _ = files.read_csv(spark, str(tmp_path), SCHEMA, missing_tokens=(), multi_line="parallel")
        assert sorted(map(tuple, parts.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("line,from_outside,from_inside", [
    ("a,b,c", False, True), ('a,"b', True, False), ('a,"b"', False, False), ('b",c', False, False),
    ('5" pipe,x', False, False), ('"a ""quoted"" b",c', False, False), ('x"",y', False, True),
    ('","', False, True), ('"', True, False), ("", False, True), ('a","b', True, True), ('a", "b', False, False)])
def test_where_a_line_ends(line, from_outside, from_inside):
    assert quoted.ends_inside(line, False) == from_outside
    assert quoted.ends_inside(line, True) == from_inside


def test_another_header_and_short_records(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,a,other,d\n1,2,3,4\n")
    with pytest.raises(ValueError, match="other"):
        files.read_csv(spark, str(tmp_path), SCHEMA, multi_line="parallel")
    (tmp_path / "x.csv").write_text('id,a,b c,d\n1,2,3,4\nx,"2\n2",3,4\n5,6\n')
    good, bad = files.read_csv(spark, str(tmp_path), SCHEMA, multi_line="parallel")
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r["failed_columns"] for r in bad.collect()) == [[], ["id"]]


def test_no_row_is_brought_together_without_need(spark, tmp_path):
    write(tmp_path / "a.csv", [(i, "x", "y", "z\n" if i == 7 else "z") for i in range(50)])
    lines = quoted.lines_of(spark, str(tmp_path))
    starts = quoted.starts_of_parts(quoted.functions_of_parts(lines))
    assert quoted.numbered(lines, starts).where("NOT whole").count() == 2


def test_records_within_a_part_are_parsed_once_and_not_brought_together(spark, tmp_path):
    write(tmp_path / "a.csv", [(i, 'a "b",\n', "\n", '\n\n,"') for i in range(30)])
    good, _ = files.read_csv(spark, str(tmp_path), SCHEMA, missing_tokens=(), multi_line="parallel")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("csvtostructs") + plan.count("from_csv") == 1 and "Aggregate" not in plan
    assert {tuple(r)[1:] for r in good.collect()} == {('a "b",\n', "\n", '\n\n,"')}


def test_states_of_many_lines_are_those_of_single_lines():
    own = random.Random(4)
    for _ in range(300):
        lines = ["".join(own.choices(['"', '""', ",", "x", '",', ',"', "é"], k=own.randrange(7))) for _ in range(9)]
        for inside in (0, 1):
            begun, end = quoted.states_of(pa.array(["skipped", *lines])[1:], inside)
            state = inside
            for line, begins in zip(lines, begun):
                assert begins == bool(state)
                state = quoted.ends_inside(line, bool(state))
            assert bool(end) == bool(state)
