"""Row shaping for sinks."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from weirflow.operators.filters import observed
from weirflow.operators.joins import update_fields
from weirflow.plans.registry import query
from weirflow.session import scratch_path
from weirflow.sources import sinks
from weirflow.sources.readers import decode_topic_payload, libsvm, numbered_files, parse_pairs, text_lines


@query(
    """SELECT c_custkey, coalesce(o_orderstatus, c_mktsegment) AS c_mktsegment, c_acctbal FROM customer LEFT JOIN (
      SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1)
    ON o_custkey = c_custkey"""
)
def field_update(t):
    changes = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max_by("o_orderstatus", "o_orderkey").alias("c_mktsegment")
    )
    customers = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return update_fields(customers, changes, "c_custkey", ["c_mktsegment"])


@query(
    """SELECT topic, CAST(event_id AS VARCHAR) AS key, props AS value FROM (
      SELECT *, CASE WHEN event_type = 'error' THEN 'alerts' WHEN event_type = 'click' THEN 'clicks' END AS topic
      FROM events) WHERE topic IS NOT NULL"""
)
def route_by_field(t):
    topic = F.when(F.col("event_type") == "error", "alerts").when(F.col("event_type") == "click", "clicks")
    return sinks.kafka_rows(t.events, "event_id", "props", topic)


@query(
    """SELECT DISTINCT 'events.' || event_type AS metric, ts, value,
      'k=' || json_extract_string(props, '$.k') || ',user=' || user_id AS tag_text FROM events"""
)
def metric_points(t):
    tagged = t.events.select(
        "event_type", "ts", "value", F.col("user_id").alias("user"), F.get_json_object("props", "$.k").alias("k")
    )
    twice = tagged.unionByName(tagged)
    points = sinks.metric_points(twice, F.concat(F.lit("events."), "event_type"), "ts", "value", ["user", "k"])
    return points.drop("tags")


@query(
    """SELECT 'parts' AS index, 'part' AS type, CAST(p_partkey AS VARCHAR) AS id,
      CAST(to_json({'p_brand': p_brand, 'p_name': string_split(p_name, ' ')}) AS VARCHAR) AS source FROM part"""
)
def index_documents(t):
    return sinks.index_documents(
        t.part, "parts", "part", "p_partkey", ["p_brand", "p_name", "no_such_field"], multi=["p_name"], token=" "
    )


@query(
    """SELECT u[2] AS user, u[4] AS device, u[3] AS location, CAST(h[1] AS DOUBLE) AS temperature,
      CAST(h[2] AS DOUBLE) AS humidity FROM (
      SELECT string_split('users/u' || user_id || '/' || event_type || '/d' || event_id, '/') AS u,
        string_split(CAST(user_id AS VARCHAR) || '.5/' || json_extract_string(props, '$.k'), '/') AS h FROM events)"""
)
def topic_payload_decode(t):
    topic = F.concat_ws(
        "/", F.lit("users"), F.concat(F.lit("u"), F.col("user_id").cast("string")), "event_type",
        F.concat(F.lit("d"), F.col("event_id").cast("string")),
    )
    payload = F.concat(F.col("user_id").cast("string"), F.lit(".5/"), F.get_json_object("props", "$.k"))
    return decode_topic_payload(t.events.select(topic.alias("topic"), payload.alias("payload")))


@query(
    """SELECT '(' || o_orderkey || ',' || o_orderstatus || ')' AS value FROM orders"""
)
def text_tuples(t):
    return sinks.text_tuples(t.orders, ["o_orderkey", "o_orderstatus"])


# --- written and read back ----------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def delimited_sink(t):
    path = scratch_path(t.spark, "delimited")
    sinks.write_delimited(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), path, "|", rows_per_file=5000)
    return t.spark.read.option("sep", "|").schema("o_orderkey long, o_custkey long, o_orderstatus string").csv(path)


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, event_id FROM events")
def partitioned_sink(t):
    path = scratch_path(t.spark, "partitioned")
    rows = sinks.with_time_partition(t.events.select("event_id", "event_type", "ts"), "ts", "yyyy-MM-dd", "day")
    sinks.write_partitioned(rows.drop("ts"), path, ["day", "event_type"])
    schema = "event_id long, day string, event_type string"
    return t.spark.read.schema(schema).parquet(path)


@query("SELECT c_custkey, c_mktsegment FROM customer")
def text_file_roundtrip(t):
    """Saved as text tuples and parsed again."""
    path = scratch_path(t.spark, "tuples")
    sinks.write_text(t.customer, path, ["c_custkey", "c_mktsegment"])
    pairs = parse_pairs(text_lines(t.spark, f"{path}/part-*"), [("c_mktsegment", "string")], "c_custkey")
    return pairs.withColumn("c_custkey", pairs["c_custkey"].cast("long"))


@query("SELECT c_custkey, c_mktsegment, c_custkey % 3 AS part FROM customer")
def recursive_text(t):
    """Text files of several folders, read by one name."""
    path = scratch_path(t.spark, "folders")
    for part in range(3):
        sinks.write_text(t.customer.where(F.col("c_custkey") % 3 == part), f"{path}/d{part}", ["c_custkey", "c_mktsegment"])
    lines = text_lines(t.spark, path, recursive=True).withColumn("file", F.input_file_name())
    pairs = parse_pairs(lines, [("c_mktsegment", "string")], "c_custkey")
    return pairs.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_mktsegment").withColumn("part", F.col("c_custkey") % 3)


@query("SELECT p_name AS value, row_number() OVER (ORDER BY p_partkey) AS line_no FROM part")
def file_line_numbers(t):
    """Numbers of lines along several files, each of which holds a range of the rows in order."""
    path = scratch_path(t.spark, "titles")
    ranges = t.part.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey")
    ranges.select(F.col("p_name").alias("value")).write.text(path)
    return numbered_files(t.spark, path).select("value", "line_no")


@query("SELECT CAST(c_nationkey AS DOUBLE) AS label, c_acctbal AS f1, CAST(c_custkey AS DOUBLE) AS f3 FROM customer")
def libsvm_rows(t):
    path = scratch_path(t.spark, "libsvm")
    line = F.concat(F.col("c_nationkey").cast("string"), F.lit(" 1:"), F.col("c_acctbal").cast("string"), F.lit(" 3:"), F.col("c_custkey").cast("string"))
    t.customer.select(line.alias("value")).write.text(path)
    vector = vector_to_array("features")
    return libsvm(t.spark, path, 3).select("label", vector[0].alias("f1"), vector[2].alias("f3"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS v FROM orders")
def sequence_file(t):
    path = scratch_path(t.spark, "pairs")
    sinks.write_key_values(t.orders, path, "o_orderkey", "o_orderstatus")
    return t.spark.createDataFrame(t.spark.sparkContext.sequenceFile(path), "k string, v string")


@query("SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events")
def table_sink(t):
    """A partitioned catalog table, written, then written again for some of its days."""
    name = f"weirflow_days_{uuid.uuid4().hex}"
    rows = t.events.select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    sinks.write_table(rows, name, ["day"])
    sinks.write_table(rows.where("day < '2024-01-10'"), name, ["day"], mode="overwrite")
    path = scratch_path(t.spark, "days")
    t.spark.table(name).select("event_id", "event_type", "day").write.parquet(path)
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.parquet(path)


@query("SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS total FROM orders WHERE o_totalprice > 100000")
def insert_select(t):
    """``INSERT INTO … SELECT`` between declared tables."""
    path, name = scratch_path(t.spark, "large"), f"weirflow_large_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE TABLE {name} (o_orderkey LONG, total DOUBLE) USING json LOCATION '{path}'")
    t.orders.createOrReplaceTempView("weirflow_orders")
    t.spark.sql(f"INSERT INTO {name} SELECT o_orderkey, o_totalprice AS total FROM weirflow_orders WHERE o_totalprice > 100000")
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.schema("o_orderkey long, total double").json(path)


@query("SELECT count(*) AS n, CAST(sum(k) AS BIGINT) AS total FROM (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)")
def observed_rows(t):
    """What a watch on rows in flight has counted when they were written."""
    k = F.get_json_object("props", "$.k").cast("long")
    watched, seen = observed(t.events.select(k.alias("k")), "rows", F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))
    watched.write.parquet(scratch_path(t.spark, "watched"))
    return t.spark.createDataFrame([(seen.get["n"], seen.get["total"])], "n long, total long")
