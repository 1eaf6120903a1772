"""Histograms of latencies, pruned log scans, rollups with late rows, files of a bounded size, aggregates by name, bounded intake
and named outputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.aggregates import weighted_mean
from weirflow.operators import histogram
from weirflow.plans.registry import Tables, query
from weirflow.plans.streams import Run, _early, _feed, _kept
from weirflow.session import scratch_path
from weirflow.sources.zones import ZonedLog, merged
from weirflow.streaming import jobs, outputs
from weirflow.streaming import tables as st
from weirflow.streaming.sources import table_stream

# --- histograms ---------------------------------------------------------------------------

SHARES = {"p50": 5000, "p99": 9900, "p999": 9990}


def _latency() -> Column:
    return F.round(F.col("value") * 1000)


def _hour() -> Column:
    return F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")


@query(
    """WITH v AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, CAST(round(value * 1000) AS BIGINT) AS v FROM events),
    s AS (SELECT *, CAST(greatest(floor(log2(greatest(v, 1))) - 10, 0) AS INTEGER) AS s FROM v),
    b AS (SELECT hour, s * 1024 + (v >> s) AS b, ((v >> s) + 1 << s) - 1 AS top, count(*) AS n FROM s GROUP BY ALL),
    both_ways AS (SELECT * FROM b UNION ALL SELECT NULL, b, top, sum(n) FROM b GROUP BY ALL),
    upto AS (SELECT *, sum(n) OVER (PARTITION BY hour ORDER BY b) AS upto, sum(n) OVER (PARTITION BY hour) AS total FROM both_ways)
    SELECT hour, CAST(any_value(total) AS BIGINT) AS n, CAST(min(top) FILTER (upto * 10000 >= total * 5000) AS BIGINT) AS p50,
      CAST(min(top) FILTER (upto * 10000 >= total * 9900) AS BIGINT) AS p99,
      CAST(min(top) FILTER (upto * 10000 >= total * 9990) AS BIGINT) AS p999 FROM upto GROUP BY hour"""
)
def latency_histogram(t):
    """Latency quantiles for each hour and in all, from bucket counts that two runs of a stream have added up."""
    counts = _kept(
        t,
        t.events.select("ts", "value"),
        _early(),
        "latencies",
        "hour timestamp_ntz, bucket long, n long",
        st.sum_by(["hour", "bucket"], ["n"]),
        lambda batch: histogram.histogram(batch.withColumn("hour", _hour()), _latency(), ["hour"]),
    )
    hourly = histogram.quantiles(counts, ["hour"], SHARES)
    whole = histogram.quantiles(histogram.merged(counts), [], SHARES)
    return hourly.unionByName(whole.withColumn("hour", F.lit(None).cast("timestamp_ntz")))


# --- pruned scans of logs -----------------------------------------------------------------


@query(
    """SELECT event_id, ts, CAST(user_id % 3 AS INTEGER) AS node FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-11 18:30:00'"""
)
def log_merge_pruned(t):
    """A range of time from the logs of three servers, each written in two runs; only files that meet the range are read."""
    start, end = F.expr("timestamp_ntz'2024-01-10 06:00:00'"), F.expr("timestamp_ntz'2024-01-11 18:30:00'")
    logs = []
    for node in range(3):
        log = ZonedLog(scratch_path(t.spark, "zoned"), "ts")
        rows = t.events.select("event_id", "ts", (F.col("user_id") % 3).cast("int").alias("node")).where(F.col("node") == node)
        for run, part in enumerate((_early(), ~_early())):
            log.write(rows.where(part), run)
        logs.append(log)
    return merged(logs, t.spark, start, end, ["ts", "event_id"])


# --- rollups ------------------------------------------------------------------------------


def _in_batches(rows: DataFrame, batches: int, label: str, job) -> Run:
    """Feed the rows by the column ``feed``, one run of the job for each of its numbers."""
    run = Run(scratch_path(rows.sparkSession, label))
    fed = rows.drop("feed")
    for number in range(batches):
        rows.where(F.col("feed") == number).drop("feed").write.mode("append").parquet(f"{run.root}/in")
        job(table_stream(rows.sparkSession, f"{run.root}/in", fed.schema), run)
    return run


@query(
    """WITH fed AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS span FROM events),
    moved AS (SELECT *, CASE WHEN event_id % 5 = 3 THEN least(span + 1, 2) ELSE span END AS feed FROM fed),
    marks AS (SELECT feed + 1 AS feed, max(max(ts)) OVER (ORDER BY feed) - INTERVAL 12 HOUR AS mark FROM moved GROUP BY feed),
    judged AS (SELECT m.*, coalesce(ts < mark, false) AS late FROM moved m LEFT JOIN marks USING (feed))
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, count(*) AS cnt, CAST(sum(user_id) AS BIGINT) AS total, late
    FROM judged GROUP BY ALL"""
)
def rollup_late(t):
    """Hourly rollups over three batches, of which two bring rows of the span before: taken for twelve hours, then diverted."""
    span = F.when(F.col("ts") < F.expr("timestamp_ntz'2024-01-11'"), 0).when(F.col("ts") < F.expr("timestamp_ntz'2024-01-21'"), 1).otherwise(2)
    feed = F.when(F.col("event_id") % 5 == 3, F.least(span + 1, F.lit(2))).otherwise(span)
    rows = t.events.select("ts", "event_type", "user_id", feed.alias("feed"))

    def job(stream: DataFrame, run: Run) -> None:
        newest = run.table("newest timestamp_ntz", jobs.newest_time)
        outputs.rollup_late(stream, run.out, f"{run.root}/late", newest, "ts", ["event_type"], "user_id", "12 hours", run.checkpoint)

    run = _in_batches(rows, 3, "rollup", job)
    segments = outputs.rolled_up(t.spark.read.parquet(run.out), ["event_type"]).withColumn("late", F.lit(False))
    late = t.spark.read.parquet(f"{run.root}/late").groupBy(_hour(), "event_type")
    late = late.agg(F.count(F.lit(1)).alias("cnt"), F.sum("user_id").alias("total"))
    return segments.unionByName(late.withColumn("late", F.lit(True)))


@query("SELECT event_id, event_type FROM events")
def size_rolled_files(t):
    """Lines in files of at most 20,000 bytes, finished files moved aside; every batch is run twice."""
    line = F.concat_ws("\t", "event_id", "event_type").alias("value")
    rows = t.events.select(line, "event_id", "ts")

    def job(stream: DataFrame, run: Run) -> None:
        for attempt in ("a", "b"):
            outputs.rolled_files(stream, "value", ["event_id"], run.out, 20_000, f"{run.checkpoint}-{attempt}")

    run = _feed(rows, _early(), "rolled-files", job)
    fields = F.split("value", "\t")
    lines = t.spark.read.text(f"{run.out}/done")
    return lines.select(F.get(fields, F.lit(0)).cast("long").alias("event_id"), F.get(fields, F.lit(1)).alias("event_type"))


# --- aggregates by name -------------------------------------------------------------------


@query("SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 9) AS mean_discount FROM lineitem GROUP BY 1")
def sql_user_aggregate(t):
    """A user's aggregate by its name in SQL; each flag is folded in pieces of consecutive orders."""
    weighted_mean(t.spark)
    t.lineitem.createOrReplaceTempView("weirflow_lineitem")
    return t.spark.sql(
        """SELECT l_returnflag, round(weighted_mean_total(part), 9) AS mean_discount FROM (
          SELECT l_returnflag, weighted_mean_part(l_discount, l_quantity) AS part FROM weirflow_lineitem
          GROUP BY l_returnflag, l_orderkey div 50000)
        GROUP BY 1"""
    )


# --- bounded intake and named outputs -----------------------------------------------------


@query(
    """SELECT 'files' AS bound, count(*) AS n_rows, 7 AS n_batches, true AS within FROM events
    UNION ALL SELECT 'bytes', count(*), 20, true FROM events"""
)
def batch_sizes(t):
    """A table that comes in 20 files: three files a batch, or so many bytes that one file fills a batch."""
    folder = scratch_path(t.spark, "files")
    rows = t.events.select("event_id", "ts", "value")
    rows.repartition(20).write.parquet(folder)
    most = t.spark.read.parquet(folder).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    found = []
    for bound, files, options in (("files", 3, {"files_per_trigger": 3}), ("bytes", 1, {"bytes_per_trigger": 1})):
        stream = table_stream(t.spark, folder, rows.schema, **options)
        out = outputs.batch_folder(scratch_path(t.spark, "batches"))
        sizes = jobs.batch_sizes(jobs.drain(stream, out, scratch_path(t.spark, "intake")))
        found.append((bound, sum(n for _, n, _ in sizes), len(sizes), all(n <= files * most for _, n, _ in sizes)))
    return t.spark.createDataFrame(found, "bound string, n_rows long, n_batches int, within boolean")


STREAMS = ("above", "near", "below")


@query(
    """WITH model AS (SELECT regr_slope(value, user_id) AS slope, regr_intercept(value, user_id) AS base FROM events),
    scored AS (SELECT event_id, value - (base + slope * user_id) AS off FROM events, model)
    SELECT CASE WHEN off > 25 THEN 'above' WHEN off < -25 THEN 'below' ELSE 'near' END AS stream, count(*) AS cnt,
      CAST(sum(event_id) AS BIGINT) AS ids FROM scored GROUP BY 1"""
)
def scored_streams(t: Tables):
    """Rows scored by a fitted line and sent to three named outputs. The first run fails between two of them and is repeated."""
    model = t.events.agg(F.regr_slope("value", "user_id").alias("slope"), F.regr_intercept("value", "user_id").alias("base")).first()
    off = F.col("value") - (F.lit(model.base) + F.lit(model.slope) * F.col("user_id"))
    name = F.when(off > 25, "above").when(off < -25, "below").otherwise("near")
    failures = [RuntimeError("an output is away")]

    def job(stream: DataFrame, run: Run) -> None:
        folders = {s: outputs.batch_folder(f"{run.out}/{s}") for s in STREAMS}

        def near(rows: DataFrame, batch_id: int) -> None:
            if failures:
                raise failures.pop()
            outputs.batch_folder(f"{run.out}/near")(rows, batch_id)

        try:
            outputs.fan_out(stream, name, folders | {"near": near}, run.checkpoint)
        except Exception as error:
            if "an output is away" not in str(error):
                raise
            outputs.fan_out(stream, name, folders, run.checkpoint)

    run = _feed(t.events.select("event_id", "user_id", "value", "ts"), _early(), "scored", job)
    counted = None
    for stream in STREAMS:
        rows = t.spark.read.parquet(f"{run.out}/{stream}").agg(F.count(F.lit(1)).alias("cnt"), F.sum("event_id").alias("ids"))
        rows = rows.where("cnt > 0").withColumn("stream", F.lit(stream))
        counted = rows if counted is None else counted.unionByName(rows)
    return counted
