"""Several sources, numbered files and shaped rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from weirflow.sources import sinks
from weirflow.sources.readers import numbered_files
from weirflow.streaming import jobs
from weirflow.streaming.sources import table_stream

START = datetime(2024, 1, 1)
SCHEMA = "id long, ts timestamp_ntz"


def at(seconds):
    return START + timedelta(seconds=seconds)


def put(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_the_slower_source_holds_windows_open(spark, tmp_path):
    folders = {s: f"{tmp_path}/{s}" for s in ("fast", "slow")}

    def run():
        streams = {s: table_stream(spark, f, SCHEMA) for s, f in folders.items()}
        jobs.run_until_empty(jobs.union_windows(streams, "ts", "10 seconds", "0 seconds"), f"{tmp_path}/out", f"{tmp_path}/cp")
        rows = spark.read.schema("window_start timestamp_ntz, source string, cnt long").parquet(f"{tmp_path}/out")
        return sorted((r.window_start, r.source, r.cnt) for r in rows.collect())

    put(spark, folders["fast"], [(1, at(1)), (2, at(2)), (3, at(100))])
    put(spark, folders["slow"], [(1, at(3))])
    assert run() == []
    put(spark, folders["slow"], [(2, at(4)), (3, at(25))])
    # Spark keeps the watermark of all, not that of each source, over a restart
    put(spark, folders["fast"], [(4, at(120))])
    # the fast source is far ahead, and yet the slow one's second row counts
    assert run() == [(at(0), "fast", 2), (at(0), "slow", 2)]
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    try:
        with pytest.raises(ValueError, match="slowest"):
            run()
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")


def test_lines_are_numbered_along_files_and_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 7) for i in range(400)]
    for number, part in enumerate((lines[:150], lines[150:151], lines[151:])):
        (tmp_path / f"part-{number}.txt").write_text("\n".join(part) + "\n")
    (tmp_path / "part-9.txt").write_text("")
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "700")
    try:
        found = numbered_files(spark, str(tmp_path))
        assert found.select("split").distinct().count() > 4
        assert {r.line_no: r.value for r in found.collect()} == {i + 1: v for i, v in enumerate(lines)}
    finally:
        spark.conf.set(setting, before)


def test_a_null_keeps_its_place_in_a_tuple(spark):
    frame = spark.createDataFrame([("a", None, 3), (None, "b", None)], "x string, y string, z int")
    assert [r.value for r in sinks.text_tuples(frame, ["x", "y", "z"]).collect()] == ["(a,null,3)", "(null,b,null)"]
    assert sinks.text_tuples(frame, ["x", "y"], null="").first().value == "(a,)"


def test_points_with_other_tags_are_other_points(spark):
    rows = [(at(0), 1.0, "1,b=2", "3"), (at(0), 1.0, "1", "2,b=3"), (at(0), 1.0, "1", "2,b=3"), (at(0), 1.0, None, "3"), (at(0), 1.0, None, "3")]
    frame = spark.createDataFrame(rows, "ts timestamp_ntz, value double, a string, b string")
    points = sinks.metric_points(frame, F.lit("m"), "ts", "value", ["a", "b"])
    assert sorted((str(r.tags["a"]), r.tags["b"]) for r in points.collect()) == [("1", "2,b=3"), ("1,b=2", "3"), ("None", "3")]
