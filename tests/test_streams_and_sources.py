"""Streams equal batches; tables survive the sinks."""

import shutil

import pytest
from pyspark.sql import functions as F

from tallyloom.catalog.streams import METRICS, clean_columns
from tallyloom.operators.dashboard import agency_dashboard
from tallyloom.sources import tables as S
from tallyloom.streaming import streams as R

from conftest import SMALL


@pytest.fixture()
def parts(spark, tmp_path):
    """The events in several files, so several micro-batches run."""
    d = str(tmp_path / "in")
    spark.read.parquet(f"{SMALL}/events.parquet").repartition(5).write.parquet(d)
    return d, spark.read.parquet(d).schema


def test_clean_stream_equals_batch(spark, parts, tmp_path):
    d, schema = parts
    out = str(tmp_path / "out")
    for _ in range(2):  # a restart must not repeat rows
        R.stream_clean(R.read_stream(spark, d, schema, max_files=1), clean_columns(), out, str(tmp_path / "log")).awaitTermination()
    batch = spark.read.parquet(d).select(*[c.alias(n) for n, c in clean_columns().items()])
    got = spark.read.parquet(out)
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0


def test_counts_stream_equals_batch(spark, parts, tmp_path):
    d, schema = parts
    out = str(tmp_path / "out")
    dec = (F.col("user_id") % 10).cast("string")
    R.stream_dashboard_counts(R.read_stream(spark, d, schema, max_files=2).withColumn("decile", dec), METRICS, out,
                              str(tmp_path / "log")).awaitTermination()
    batch = agency_dashboard(spark.read.parquet(d).withColumn("decile", dec), METRICS)
    got = R.read_batches(spark, out, latest=True)
    assert got.exceptAll(batch).count() == 0 and got.count() == batch.count()


def test_csv_keeps_quotes_and_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c\nd'), (2, "\\x\\"), (3, None)], "id int, t string")
    S.write_table(df, str(tmp_path / "c"), "csv")
    assert sorted(map(tuple, S.read_csv(spark, str(tmp_path / "c"), df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Agency ` int, `If Other, please explain..1` int, `Keep` int")
    with pytest.warns(UserWarning, match="Absent"):
        out = S.rename_columns(df, {"Agency": "agency", "Absent": "x"}, ["If Other, please explain"])
    assert out.columns == ["agency", "if_other_please_explain1", "Keep"]
    assert S.find_column(df, r"other") == "If Other, please explain..1"
    assert S.find_column(df, "zzz") is None


def test_csv_is_read_by_its_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b,a,"x y"\n1,"two\nlines",3\n4,"say ""hi""",\n')
    df = S.read_inventory(spark, str(tmp_path / "a.csv"), ["a", "b"])
    assert df.columns == ["a", "b"]
    assert sorted(map(tuple, df.collect())) == [('say "hi"', "4"), ("two\nlines", "1")]
    assert S.read_inventory(spark, str(tmp_path / "a.csv")).columns == ["b", "a", "x y"]
    with pytest.raises(ValueError, match="not found"):
        S.read_inventory(spark, str(tmp_path / "a.csv"), ["a", "absent"])
    typed = S.read_csv(spark, str(tmp_path / "a.csv"), "a string, b int")
    assert sorted(r.b for r in typed.collect()) == [1, 4]
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception):
        S.read_inventory(spark, str(folder), ["a", "b"], fmt="csv").collect()


@pytest.mark.parametrize("parts", [0, 3])
def test_streams_read_a_table_of_one_file_or_many(spark, tmp_path, parts):
    """``parts`` files in a folder of the table's name, or the file itself."""
    from tallyloom.catalog.streams import r01
    source = f"{SMALL}/events.parquet"
    if parts:
        spark.read.parquet(source).repartition(parts).write.parquet(f"{tmp_path}/events.parquet")
    else:
        shutil.copy(source, tmp_path)
    assert r01(spark, str(tmp_path)).count() == spark.read.parquet(source).count()
