"""Row shaping and batch writers."""

import glob
import json

from pyspark.sql import functions as F

from weirflow.sources import sinks
from weirflow.sources.readers import parse_pairs, text_lines


def test_topic_per_row(spark, rows):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "id int, kind string")
    assert rows(sinks.kafka_rows(frame, "id", "kind", F.col("kind"))) == [("a", "1", "a")]
    assert rows(sinks.kafka_rows(frame, "id", "id", F.col("kind"), default="rest"), "topic") == [("a",), ("rest",)]


def test_index_documents(spark):
    frame = spark.createDataFrame([(1, "a|b", "x")], "id int, tags string, other string")
    row = sinks.index_documents(frame, "i", "t", "id", ["id", "tags", "missing"], multi=["tags"]).first()
    assert json.loads(row.source) == {"id": 1, "tags": ["a", "b"]}
    assert (row["index"], row.type, row.id) == ("i", "t", "1")


def test_delimited_files_rotate(spark, tmp_path):
    sinks.write_delimited(spark.range(25).coalesce(1), f"{tmp_path}/out", "\t", rows_per_file=10)
    assert len(glob.glob(f"{tmp_path}/out/part-*")) == 3


def test_folders_by_value_and_time(spark, tmp_path, rows):
    frame = spark.sql("SELECT id, timestamp_ntz'2024-03-05 01:02:03' AS ts, 'hot' AS city FROM range(20)")
    timed = sinks.with_time_partition(frame, "ts")
    assert timed.first().part == "2024/03/05"
    sinks.write_partitioned(timed, f"{tmp_path}/out", ["city"], rows_per_file=4)
    files = glob.glob(f"{tmp_path}/out/city=hot/part-*")
    assert len(files) > 4 and spark.read.parquet(f"{tmp_path}/out").count() == 20


def test_table_partitions_appear_and_are_replaced_alone(spark):
    name = "sink_table_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        sinks.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), name, ["p"])
        sinks.write_table(spark.createDataFrame([("c", 3)], "p string, v int"), name, ["p"])
        sinks.write_table(spark.createDataFrame([(9, "a")], "v int, p string"), name, ["p"], mode="overwrite")
        assert sorted((r.p, r.v) for r in spark.table(name).collect()) == [("a", 9), ("b", 2), ("c", 3)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_text_tuples_keep_other_alphabets(spark, tmp_path, rows):
    frame = spark.createDataFrame([("ä日", 1)], "k string, v int")
    sinks.write_text(frame, f"{tmp_path}/out", ["k", "v"])
    assert rows(parse_pairs(text_lines(spark, f"{tmp_path}/out"), [("v", "int")], "k")) == [("ä日", 1)]


def test_sequence_file(spark, tmp_path):
    sinks.write_key_values(spark.createDataFrame([("k", "v")], "a string, b string"), f"{tmp_path}/out", "a", "b")
    assert spark.sparkContext.sequenceFile(f"{tmp_path}/out").collect() == [("k", "v")]


def test_repeated_points_go(spark):
    frame = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS ts, 1.5D AS v, 'x' AS host FROM range(3)")
    point = sinks.metric_points(frame, F.lit("cpu"), "ts", "v", ["host"]).collect()
    assert [(p.metric, p.value, p.tags) for p in point] == [("cpu", 1.5, {"host": "x"})]


def test_external_tables_and_plans(spark, tmp_path):
    """Tables declared in SQL, and a plan shown instead of run."""
    spark.sql("DROP TABLE IF EXISTS orders_in")
    spark.sql("DROP TABLE IF EXISTS orders_out")
    try:
        spark.sql(f"CREATE TABLE orders_in (id INT, unit_price INT, quantity INT) USING parquet LOCATION '{tmp_path}/in'")
        spark.sql(f"CREATE TABLE orders_out (id INT, total INT) USING json LOCATION '{tmp_path}/out'")
        spark.sql("INSERT INTO orders_in VALUES (1, 10, 6), (2, 10, 5)")
        insert = "INSERT INTO orders_out SELECT id, unit_price * quantity AS total FROM orders_in WHERE unit_price * quantity > 50"
        plan = spark.sql(f"EXPLAIN FORMATTED {insert}").first().plan
        assert "InsertIntoHadoopFsRelationCommand" in plan and spark.table("orders_out").count() == 0
        spark.sql(insert)
        assert [tuple(r) for r in spark.table("orders_out").collect()] == [(1, 60)]
    finally:
        spark.sql("DROP TABLE IF EXISTS orders_in")
        spark.sql("DROP TABLE IF EXISTS orders_out")


def test_parallelism_hint(spark):
    spark.range(10).createOrReplaceTempView("hinted")
    assert spark.sql("SELECT /*+ REPARTITION(3) */ id FROM hinted").rdd.getNumPartitions() == 3
