"""Quoted CSV in byte ranges against Python's reader."""

import csv
import io
import random

import pytest

from tallyloom.sources import quoted as Q
from tallyloom.sources import tables as S


def made(seed, rows=25):
    r = random.Random(seed)
    parts = ["a", "x y", '"', '""', ",", "\n", "\r\n", "\n\n", "é", "z" * 40, " lead", "'"]
    # An empty field, quoted or not, is a missing one.
    return [["".join(r.choice(parts) for _ in range(r.randint(1, 6))) for _ in range(3)] + [str(i)] for i in range(rows)]


@pytest.mark.parametrize("size,end", [(97, "\n"), (160, "\r\n"), (10**6, "\n")])
def test_ranges_of_any_size(spark, tmp_path, size, end):
    """Ranges far shorter than records, within quotes, between the two bytes of a line end."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        want = []
        for k in range(2):
            rows = made(k * 10 + size)
            out = io.StringIO(newline="")
            csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL).writerows([["one", 'the "second"\nquestion', "c,d", "id"], *rows])
            (tmp_path / f"{k}.csv").write_text(out.getvalue(), newline="")
            want += rows
        df = Q.read_quoted(spark, str(tmp_path))
        assert df.columns == ["one", 'the "second"\nquestion', "c,d", "id"]
        got = [list(r) for r in df.collect()]
        if size < 1000:
            assert Q._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted(want)


def test_empty_fields_blank_lines_and_short_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,c\n1,,"x"\n\n2,""\n"3\n",y,"" \n')
    got = S.read_inventory(spark, str(tmp_path / "a.csv")).collect()
    assert [(r.a, r.b) for r in got] == [("1", None), ("2", None), ("3\n", "y")]
    (tmp_path / "none.csv").write_text("")
    assert Q.read_quoted(spark, str(tmp_path / "none.csv")).columns == []
    (tmp_path / "head.csv").write_text("a,b\n")
    only = Q.read_quoted(spark, str(tmp_path / "head.csv"))
    assert only.columns == ["a", "b"] and only.count() == 0


def test_text_is_not_shuffled(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    plan = Q.read_quoted(spark, str(tmp_path / "a.csv"))._jdf.queryExecution().executedPlan().toString()
    whole = plan.split("Union")[1].split("MapInArrow")[0]
    assert "Exchange" not in whole
