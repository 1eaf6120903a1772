"""Streams of several tables, streams behind declared tables, dropped files with all their rows, and counts of several shards."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.operators import lossy
from weirflow.operators.ordered import row_index
from weirflow.plans.registry import query
from weirflow.plans.streams import HALF, Run, _early, _events
from weirflow.session import scratch_path
from weirflow.sources.readers import permissive_json
from weirflow.streaming import jobs
from weirflow.streaming.sources import dropped_files, table_stream

# --- several sources ----------------------------------------------------------------------


def _two_fed(label: str, feeds: dict[str, tuple[DataFrame, Column]], job) -> Run:
    """Feed each source into its own folder in two runs: the rows for which its column is 0, then those for which it is 1."""
    run, spark = None, None
    for turn in range(2):
        streams = {}
        for name, (rows, fed) in feeds.items():
            spark = rows.sparkSession
            run = run or Run(scratch_path(spark, label))
            rows.where(fed == turn).write.mode("append").parquet(f"{run.root}/{name}")
            streams[name] = table_stream(spark, f"{run.root}/{name}", rows.schema)
        job(streams, run)
    return run


@query(
    """WITH rows AS (SELECT 'event' AS source, ts FROM events
      UNION ALL SELECT 'document', TIMESTAMP '2024-01-01' + doc_id * INTERVAL 40 MINUTE FROM documents),
    mark AS (SELECT min(newest) - INTERVAL 1 HOUR AS mark FROM (SELECT max(ts) AS newest FROM rows GROUP BY source))
    SELECT * FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, source, count(*) AS cnt FROM rows GROUP BY 1, 2)
    WHERE day + INTERVAL 1 DAY <= (SELECT mark FROM mark)"""
)
def union_two_sources(t):
    """Two tables into one stream of daily counts. A day is closed when the slower source has passed it."""
    at = F.timestamp_micros(F.expr("unix_micros(timestamp'2024-01-01')") + F.col("doc_id") * 2_400_000_000).cast("timestamp_ntz")
    documents = t.documents.select("doc_id", at.alias("ts"))
    third = F.expr("timestamp_ntz'2024-01-06'")
    feeds = {
        "event": (t.events.select("event_id", "ts"), (~_early()).cast("int")),
        "document": (documents, (F.col("ts") >= third).cast("int")),
    }

    def job(streams: dict[str, DataFrame], run: Run) -> None:
        counted = jobs.union_windows(streams, "ts", "1 day", "1 hour")
        jobs.run_until_empty(counted, run.out, run.checkpoint)

    run = _two_fed("union-two", feeds, job)
    return t.spark.read.parquet(run.out).select(F.col("window_start").alias("day"), "source", "cnt")


SHIFTED = f"""lhs AS (SELECT event_id, ts, ts >= TIMESTAMP '{HALF}' AS second FROM events),
    rhs AS (SELECT event_id, ts + event_id % 5 * INTERVAL 20 SECOND AS ts, ts >= TIMESTAMP '{HALF}' OR event_id % 7 = 3 AS second FROM events),
    mark AS (SELECT date_trunc('milliseconds', least((SELECT max(ts) FROM lhs WHERE NOT second), (SELECT max(ts) FROM rhs WHERE NOT second)))
      - INTERVAL 45 SECOND AS mark)"""


@query(
    f"""WITH {SHIFTED} SELECT l.event_id, CAST(epoch_us(r.ts - l.ts) // 1000000 AS BIGINT) AS delay FROM lhs l JOIN rhs r USING (event_id)
    WHERE r.ts <= l.ts + INTERVAL 45 SECOND AND (NOT r.second OR r.ts > (SELECT mark FROM mark))"""
)
def stream_shifted_join(t):
    """Rows joined to partners that come up to 80 seconds later, of which 45 are waited for, and some after the watermark."""
    second = ~_early()
    left = t.events.select("event_id", "ts", second.cast("int").alias("fed"))
    shifted = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 5 * 20_000_000).cast("timestamp_ntz")
    right = t.events.select("event_id", shifted.alias("later"), (second | (F.col("event_id") % 7 == 3)).cast("int").alias("fed"))
    feeds = {"left": (left, F.col("fed")), "right": (right, F.col("fed"))}

    def job(streams: dict[str, DataFrame], run: Run) -> None:
        joined = jobs.join_streams(streams["left"].drop("fed"), streams["right"].drop("fed"), "event_id", "ts", "later", "45 seconds")
        delay = (F.unix_micros("later") - F.unix_micros("ts")) / 1_000_000
        jobs.run_until_empty(joined.select("event_id", delay.cast("long").alias("delay")), run.out, run.checkpoint)

    run = _two_fed("shifted-join", feeds, job)
    return t.spark.read.parquet(run.out)


# --- files and tables ---------------------------------------------------------------------


@query(
    """SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS bad FROM events WHERE event_type <> 'error'
    UNION ALL SELECT NULL, NULL, '{bad ' || event_id FROM events WHERE event_type = 'error'"""
)
def dir_stream_rows(t):
    """Lines of dropped files, parsed, and beside them the lines that did not parse: no line is lost."""
    run = Run(scratch_path(t.spark, "dropped-rows"))
    good = F.to_json(F.struct("event_id", "event_type"))
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{bad "), F.col("event_id").cast("string"))).otherwise(good)
    schema = "event_id long, event_type string"
    for part in (_early(), ~_early()):
        t.events.where(part).select(line.alias("value")).write.mode("append").text(f"{run.root}/in")

        def step(batch: DataFrame, batch_id: int) -> None:
            parsed, bad = permissive_json(batch, schema)
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in parsed.schema]
            rows = parsed.withColumn("bad", F.lit(None).cast("string")).unionByName(bad.select(*nothing, F.col("value").alias("bad")))
            rows.write.mode("overwrite").parquet(f"{run.out}/batch_id={batch_id}")

        jobs.drain(dropped_files(t.spark, f"{run.root}/in"), step, run.checkpoint)
    return t.spark.read.parquet(run.out).drop("batch_id")


@query("SELECT event_id, value * 2 AS doubled FROM events WHERE value > 100")
def declared_stream(t):
    """A stream from one declared table into another, written in SQL; rows are inserted twice."""
    spark, tag = t.spark, uuid.uuid4().hex
    source, sink = f"weirflow_in_{tag}", f"weirflow_out_{tag}"
    path = scratch_path(spark, "declared")
    spark.sql(f"CREATE TABLE {source} (event_id LONG, value DOUBLE) USING parquet LOCATION '{path}/in'")
    spark.sql(f"CREATE TABLE {sink} (event_id LONG, doubled DOUBLE) USING parquet LOCATION '{path}/out'")
    try:
        for part in (_early(), ~_early()):
            t.events.where(part).select("event_id", "value").createOrReplaceTempView(f"part_{tag}")
            spark.sql(f"INSERT INTO {source} SELECT * FROM part_{tag}")
            spark.readStream.table(source).createOrReplaceTempView(f"stream_{tag}")
            rows = spark.sql(f"SELECT event_id, value * 2 AS doubled FROM stream_{tag} WHERE value > 100")
            rows.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).toTable(sink).awaitTermination()
    finally:
        for view in ("part", "stream"):
            spark.catalog.dropTempView(f"{view}_{tag}")
        for table in (source, sink):
            spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(f"{path}/out")


@query("SELECT 3 AS n_parts, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders")
def parallel_source(t):
    """A source that is read by as many tasks as its hint says."""
    t.orders.createOrReplaceTempView("weirflow_hinted")
    rows = t.spark.sql("SELECT /*+ REPARTITION(3) */ o_orderkey FROM weirflow_hinted").withColumn("part", F.spark_partition_id())
    sums = [F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("total")]
    return rows.agg(F.count_distinct("part").cast("int").alias("n_parts"), *sums)


# --- shards -------------------------------------------------------------------------------


@query(
    """WITH placed AS (SELECT user_id % 4 AS shard, event_type, row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS n FROM events),
    ranked AS (SELECT *, (n - 1) // 50 + 1 AS b, row_number() OVER (PARTITION BY shard, event_type ORDER BY n) AS c FROM placed),
    estimated AS (SELECT *, c + max(b - c) OVER (PARTITION BY shard, event_type ORDER BY n) AS e FROM ranked),
    entered AS (SELECT *, (lag(e) OVER w IS NULL OR lag(e) OVER w <= b - 1) AS entering FROM estimated
      WINDOW w AS (PARTITION BY shard, event_type ORDER BY n)),
    finished AS (SELECT shard, count(*) // 50 AS buckets FROM placed GROUP BY 1),
    held AS (SELECT shard, event_type, max(e) AS estimate, max(b - 1) FILTER (entering) AS delta FROM entered GROUP BY ALL),
    kept AS (SELECT held.*, buckets FROM held JOIN finished USING (shard) WHERE estimate > buckets),
    merged AS (SELECT event_type, sum(estimate - delta) AS f, sum(delta) + (SELECT sum(buckets) FROM finished) - sum(buckets) AS delta
      FROM kept GROUP BY 1)
    SELECT event_type, CAST(f AS BIGINT) AS f, CAST(delta AS BIGINT) AS delta, CAST(f + delta AS BIGINT) AS estimate FROM merged"""
)
def lossy_shards(t):
    """Lossy counts of four shards of the events, merged with the errors that each shard allows."""
    rows = t.events.select("event_id", "event_type", (F.col("user_id") % 4).cast("int").alias("shard"))
    placed = row_index(rows, ["event_id"], ["shard"], "n")
    states = None
    for shard in range(4):
        own = placed.where(F.col("shard") == shard)
        state = lossy.lossy_count(own, "event_type", "n", 50, own.agg(F.count(F.lit(1)).alias("n")))
        state = state.withColumn("shard", F.lit(shard))
        states = state if states is None else states.unionByName(state)
    finished = rows.groupBy("shard").agg(F.expr("count(1) div 50").alias("buckets"))
    return lossy.merge_shards(states, "event_type", finished, "shard")
