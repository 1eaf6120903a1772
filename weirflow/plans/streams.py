"""Streaming jobs over the given tables. Each table is fed in two runs, the second starting from the
checkpoint of the first, and the result is what the stream's table holds in the end.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.operators.filters import words
from weirflow.operators import windows
from weirflow.operators.joins import lookup
from weirflow.plans.registry import Tables, query
from weirflow.plans.social import K, _k
from weirflow.plans.words import ASKED, COUNTS
from weirflow.session import scratch_path
from weirflow.sources.readers import permissive_json
from weirflow.streaming import jobs
from weirflow.streaming import tables as st
from weirflow.streaming.sources import dropped_files, table_stream

HALF = "2024-01-16 00:00:00"


@dataclass(frozen=True)
class Run:
    """The folders of one job, below the shared folder."""

    root: str

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    @property
    def out(self) -> str:
        return f"{self.root}/out"

    def table(self, schema: str, merge: st.Merge) -> st.BatchTable:
        return st.BatchTable(f"{self.root}/table", schema, merge)


def _feed(rows: DataFrame, first: Column, label: str, job: Callable[[DataFrame, Run], None]) -> Run:
    """Run a job on the rows for which ``first`` holds, and again after the other rows have come."""
    spark = rows.sparkSession
    run = Run(scratch_path(spark, label))
    for part in (first, ~first):
        rows.where(part).write.mode("append").parquet(f"{run.root}/in")
        job(table_stream(spark, f"{run.root}/in", rows.schema), run)
    return run


def _early() -> Column:
    return F.col("ts") < F.expr(f"timestamp_ntz'{HALF}'")


def _events(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts", "user_id", "event_type", "value", _k().alias("k"))


def _kept(t: Tables, rows: DataFrame, first: Column, label: str, schema: str, merge: st.Merge, contribution):
    """Feed rows into a table kept by batch, and read the table."""
    run = _feed(
        rows,
        first,
        label,
        lambda stream, r: jobs.keep_table(stream, r.table(schema, merge), contribution, r.checkpoint),
    )
    return run.table(schema, merge).read(t.spark)


def _word_table(t: Tables) -> DataFrame:
    return _kept(
        t,
        t.documents.select("doc_id", "text"),
        F.col("doc_id") % 2 == 0,
        "words",
        "word string, cnt long",
        st.sum_by(["word"], ["cnt"]),
        lambda batch: words(batch, "text").groupBy("word").agg(F.count(F.lit(1)).alias("cnt")),
    )


@query(f"WITH {COUNTS} SELECT word, cnt FROM counts")
def stream_word_count(t):
    return _word_table(t)


@query(f"WITH {COUNTS}, {ASKED} SELECT word, cnt FROM asked JOIN counts USING (word)")
def stream_state_query(t):
    return st.query_state(words(t.benchmark, "text"), _word_table(t), "word")


@query("SELECT event_type, count(*) AS cnt FROM events GROUP BY 1")
def exactly_once_count(t):
    """Every batch is applied twice, as after a failure between its write and its commit."""
    schema, merge = "event_type string, cnt long", st.sum_by(["event_type"], ["cnt"])

    def job(stream: DataFrame, run: Run) -> None:
        def step(batch: DataFrame, batch_id: int) -> None:
            counts = batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
            for _attempt in range(2):
                run.table(schema, merge).write(counts, batch_id)

        jobs.drain(stream, step, run.checkpoint)

    return _feed(_events(t), _early(), "once", job).table(schema, merge).read(t.spark)


@query(f"SELECT DISTINCT user_id, {K} AS follower FROM events")
def merge_set(t):
    pairs = _events(t).select("user_id", F.col("k").alias("follower"), "ts")
    return _kept(
        t,
        pairs,
        _early(),
        "set",
        "user_id long, follower long",
        st.distinct_rows(["user_id", "follower"]),
        lambda batch: batch.select("user_id", "follower").distinct(),
    )


NEWEST = "arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id"


@query(f"SELECT user_id, {NEWEST}, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def merge_upsert(t):
    columns = ["event_id", "event_type", "value"]
    newest = F.max_by(F.struct(*columns), "event_id").alias("row")
    return _kept(
        t,
        _events(t),
        F.col("event_id") % 2 == 1,
        "upsert",
        "user_id long, event_id long, event_type string, value double",
        st.newest_by(["user_id"], ["event_id"], columns),
        lambda batch: batch.groupBy("user_id").agg(newest).select("user_id", "row.*"),
    )


@query(f"SELECT user_id, count(*) AS n, CAST(sum({K}) AS BIGINT) AS k_total, {NEWEST} FROM events GROUP BY user_id")
def counter_upsert(t):
    newest = F.max_by(F.struct("event_id", "event_type"), "event_id").alias("row")
    return _kept(
        t,
        _events(t),
        F.col("event_id") % 2 == 1,
        "counters",
        "user_id long, n long, k_total long, event_id long, event_type string",
        st.counters_and_columns(["user_id"], ["n", "k_total"], ["event_id", "event_type"], ["event_id"]),
        lambda batch: batch.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k_total"), newest)
        .select("user_id", "n", "k_total", "row.*"),
    )


@query(
    """SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value FROM events GROUP BY user_id
    HAVING max(ts) + INTERVAL 12 HOUR > TIMESTAMP '2024-01-30 06:00:00'"""
)
def ttl_store(t):
    newest = F.max_by(F.struct("ts", "value"), "ts").alias("row")
    table = _kept(
        t,
        _events(t),
        _early(),
        "ttl",
        "user_id long, ts timestamp_ntz, value double",
        st.newest_by(["user_id"], ["ts"], ["ts", "value"]),
        lambda batch: batch.groupBy("user_id").agg(newest).select("user_id", "row.*"),
    )
    return st.unexpired(table, "ts", "12 hours", "2024-01-30 06:00:00")


@query(
    f"""SELECT CAST(ts >= TIMESTAMP '{HALF}' AS INTEGER) AS batch_id, event_type, count(*) AS cnt FROM events GROUP BY ALL"""
)
def snapshot_per_batch(t):
    run = _feed(_events(t), _early(), "snapshots", lambda s, r: jobs.snapshot_per_batch(s, r.out, r.checkpoint))
    snapshots = t.spark.read.parquet(run.out)
    return snapshots.groupBy("batch_id", "event_type").agg(F.count(F.lit(1)).alias("cnt"))


@query(
    """SELECT event_id, event_type, row_number() OVER w AS n, CAST(sum(user_id) OVER w AS BIGINT) AS total FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY event_id)"""
)
def stream_running_values(t):
    schema, merge = "event_type string, n long, total long", st.sum_by(["event_type"], ["n", "total"])
    rows = _events(t).select("event_id", "event_type", "user_id", "ts")
    run = _feed(
        rows,
        _early(),
        "running",
        lambda s, r: jobs.running_values(
            s, r.table(schema, merge), r.out, "user_id", ["event_id"], ["event_type"], r.checkpoint
        ),
    )
    return t.spark.read.parquet(run.out).select("event_id", "event_type", "n", "total")


@query(
    """SELECT event_type, (n - 1) // 100 AS window_no, count(*) AS cnt, CAST(sum(user_id) AS BIGINT) AS total FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events)
    GROUP BY ALL HAVING count(*) = 100"""
)
def stream_count_windows(t):
    schema, merge = "event_type string, n long", st.sum_by(["event_type"], ["n"])
    run = _feed(
        _events(t),
        _early(),
        "count-windows",
        lambda s, r: jobs.count_windows(
            s, r.table(schema, merge), r.out, 100, "user_id", ["event_id"], ["event_type"], r.checkpoint
        ),
    )
    return jobs.complete_windows(t.spark.read.parquet(run.out), 100, ["event_type"])


@query(
    """WITH parts AS (SELECT *, event_id % 2 AS part FROM events)
    SELECT event_id, ts < (SELECT max(ts) FROM parts WHERE part = 0) - INTERVAL 10 DAY AS late FROM parts WHERE part = 1
    UNION ALL SELECT event_id, false FROM parts WHERE part = 0"""
)
def late_rows(t):
    run = _feed(
        _events(t),
        F.col("event_id") % 2 == 0,
        "late",
        lambda s, r: jobs.divert_late(
            s, r.table("newest timestamp_ntz", jobs.newest_time), r.out, f"{r.root}/late", "ts", "10 days", r.checkpoint
        ),
    )
    on_time = t.spark.read.parquet(run.out).select("event_id", F.lit(False).alias("late"))
    late = t.spark.read.parquet(f"{run.root}/late").select("event_id", F.lit(True).alias("late"))
    return on_time.unionByName(late)


@query(
    f"""WITH one AS (SELECT event_type, count(*) AS c FROM events WHERE ts < TIMESTAMP '{HALF}' GROUP BY 1),
    two AS (SELECT event_type, count(*) AS c FROM events WHERE NOT ts < TIMESTAMP '{HALF}' GROUP BY 1),
    n AS (SELECT (SELECT coalesce(sum(c), 0) FROM one) AS n1, (SELECT coalesce(sum(c), 0) FROM two) AS n2),
    first AS (SELECT event_type, c AS f, 0 AS delta FROM one, n WHERE c > n1 // 100),
    second AS (SELECT coalesce(first.event_type, two.event_type) AS event_type, coalesce(f, 0) + coalesce(c, 0) AS f,
      coalesce(delta, n1 // 100) AS delta FROM n, first FULL JOIN two ON first.event_type = two.event_type)
    SELECT event_type, CAST(f AS BIGINT) AS f, CAST(delta AS BIGINT) AS delta, CAST(f + delta AS BIGINT) AS estimate
    FROM second, n WHERE f + delta > (n1 + n2) // 100"""
)
def stream_lossy_count(t):
    schema = "event_type string, f long, delta long, seen long"

    def job(stream: DataFrame, run: Run) -> None:
        table = run.table(schema, lambda df: df)
        jobs.drain(stream, jobs.lossy_step(table, "event_type", 100), run.checkpoint)

    run = _feed(_events(t), _early(), "lossy", job)
    return jobs.lossy_result(run.table(schema, lambda df: df), t.spark, "event_type")


# --- Spark's own streaming state ----------------------------------------------------------


def _appended(t: Tables, label: str, frame: Callable[[DataFrame], DataFrame]) -> DataFrame:
    run = _feed(
        _events(t), _early(), label, lambda s, r: jobs.run_until_empty(frame(s), r.out, r.checkpoint)
    )
    return t.spark.read.parquet(run.out)


HOURLY = """WITH hourly AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS cnt
  FROM events GROUP BY ALL)"""


@query(
    f"""{HOURLY} SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, cnt FROM hourly
    WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""
)
def stream_windows(t):
    return _appended(
        t,
        "windows",
        lambda s: jobs.windowed_counts(s, "ts", "1 hour", "1 hour", "10 minutes", ["event_type"]),
    )


@query(
    f"""{HOURLY} SELECT window_start, event_type, cnt FROM hourly
    WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""
)
def stream_salted_windows(t):
    parts = _appended(
        t, "salted", lambda s: jobs.salted_counts(s, "ts", "1 hour", "10 minutes", "event_type", "event_id")
    )
    return parts.groupBy("window_start", "event_type").agg(F.sum("cnt").alias("cnt"))


@query("SELECT event_id, event_type FROM events")
def stream_once_per_id(t):
    return _appended(
        t, "ids", lambda s: jobs.once_per_id(s.unionByName(s), "ts", "event_id", "1 hour").select("event_id", "event_type")
    )


@query("SELECT event_id, event_type, value FROM events")
def stream_interval_join(t):
    def joined(s: DataFrame) -> DataFrame:
        kinds = s.select("event_id", "event_type", F.col("ts").alias("kind_ts"))
        values = s.select("event_id", "value", F.col("ts").alias("value_ts"))
        return jobs.join_streams(kinds, values, "event_id", "kind_ts", "value_ts", "30 seconds").drop("kind_ts", "value_ts")

    return _appended(t, "join", joined)


@query("SELECT event_id, 'view' AS tag FROM events WHERE event_type = 'view' UNION ALL SELECT event_id, 'all' FROM events")
def union_streams(t):
    """Two streams of different origin into one operator."""

    def both(s: DataFrame) -> DataFrame:
        views = s.where("event_type = 'view'").select("event_id", F.lit("view").alias("tag"))
        return views.unionByName(s.select("event_id", F.lit("all").alias("tag")))

    return _appended(t, "union", both)


@query("SELECT event_id, event_type FROM events WHERE event_type <> 'error'")
def dir_stream(t):
    """Lines of files dropped into a folder; lines that are no JSON are diverted."""
    run = Run(scratch_path(t.spark, "dropped"))
    good = F.to_json(F.struct("event_id", "event_type"))
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{bad "), F.col("event_id").cast("string"))).otherwise(good)
    for part in (_early(), ~_early()):
        t.events.where(part).select(line.alias("value")).write.mode("append").text(f"{run.root}/in")
        lines = dropped_files(t.spark, f"{run.root}/in", archive=f"{run.root}/archive")

        def step(batch: DataFrame, batch_id: int) -> None:
            parsed, bad = permissive_json(batch, "event_id long, event_type string")
            parsed.write.mode("overwrite").parquet(f"{run.out}/batch_id={batch_id}")
            bad.write.mode("overwrite").text(f"{run.root}/bad/batch_id={batch_id}")

        jobs.drain(lines, step, run.checkpoint)
    return t.spark.read.parquet(run.out).drop("batch_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def stream_blocklist(t):
    """The block list is read anew for every batch."""
    run = _feed(
        t.documents.select("doc_id", "source"),
        F.col("doc_id") % 2 == 0,
        "blocklist",
        lambda s, r: jobs.without_blocked(s, lambda: t.labels.where("toxic = 1"), "doc_id", r.out, r.checkpoint),
    )
    return t.spark.read.parquet(run.out).drop("batch_id")


@query("SELECT event_id, c_mktsegment FROM events LEFT JOIN customer ON c_custkey = user_id")
def stream_lookup(t):
    """Stream rows enriched from a static table; misses stay as null."""
    customers = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_acctbal")
    return _appended(
        t, "lookup", lambda s: lookup(s, customers, "user_id", ["c_mktsegment"]).select("event_id", "c_mktsegment")
    )


# --- windows, rankings and joins kept over batches -----------------------------------------


DAILY_SLIDES = """WITH slid AS (SELECT window_start, event_type, count(*) AS cnt FROM (
    SELECT event_type, unnest([time_bucket(INTERVAL 1 DAY, ts), time_bucket(INTERVAL 1 DAY, ts) - INTERVAL 1 DAY]) AS window_start
    FROM events) GROUP BY ALL)"""


@query(
    f"""{DAILY_SLIDES} SELECT window_start, window_start + INTERVAL 2 DAY AS window_end, event_type, cnt FROM slid
    WHERE window_start + INTERVAL 2 DAY <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""
)
def stream_sliding_windows(t):
    return _appended(
        t, "sliding", lambda s: jobs.windowed_counts(s, "ts", "2 days", "1 day", "10 minutes", ["event_type"])
    )


ROLLED = """slots AS (SELECT CAST(user_id AS VARCHAR) AS obj, epoch_us(ts) // 3600000000 AS pane FROM events),
    ends AS (SELECT obj, e, sum(c) AS cnt FROM (
      SELECT obj, unnest(range(pane + 1, pane + 8)) AS e, unnest([1, 1, 1, 1, 1, 1, 0]) AS c FROM slots) GROUP BY ALL),
    rolled AS (SELECT obj, CAST(cnt AS BIGINT) AS cnt, make_timestamp(e * 3600000000) AS window_end,
      CAST(least(6 * 3600, (e - (SELECT min(pane) FROM slots)) * 3600) AS BIGINT) AS window_seconds FROM ends)"""


def _rolled(t: Tables, label: str) -> DataFrame:
    """Rolling counts of six hours, emitted each hour, from pane counts that two runs of a stream have added up."""
    merge = st.sum_by(["who", "pane"], ["n"])
    schema = "who string, pane long, n long"

    def job(stream: DataFrame, run: Run) -> None:
        jobs.keep_table(stream, run.table(schema, merge), lambda b: windows.pane_counts(b, "ts", "who", 3600), run.checkpoint)

    uses = t.events.select(F.col("user_id").cast("string").alias("who"), "ts")
    run = _feed(uses, _early(), label, job)
    return windows.rolling_from_panes(run.table(schema, merge).read(t.spark), "who", 6 * 3600, 3600)


@query(f"WITH {ROLLED} SELECT * FROM rolled")
def stream_rolling_count(t):
    return _rolled(t, "rolling")


@query(
    f"""WITH {ROLLED} SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, obj) AS rank
      FROM rolled WHERE cnt > 0) WHERE rank <= 3"""
)
def stream_topn(t):
    return windows.top_n_per(_rolled(t, "ranking"), 3, "cnt", "obj", ["window_end"])


@query(
    """WITH last AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, user_id, arg_max(value, event_id) AS value FROM events GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY value DESC, user_id) AS r FROM last)
    SELECT '<' || strftime(w, '%Y-%m-%d %H:%M:%S') || '>' || string_agg('<' || user_id || '>', '' ORDER BY r) AS value
    FROM ranked WHERE r <= 5 GROUP BY w"""
)
def flush_log(t):
    """The log of the largest values at each flush, from the newest value of each key and hour that a stream keeps."""
    schema = "window_start timestamp_ntz, user_id long, value double, event_id long"
    merge = st.newest_by(["window_start", "user_id"], ["event_id"], ["window_start", "user_id", "value", "event_id"])

    def newest(batch: DataFrame) -> DataFrame:
        placed = batch.withColumn("window_start", F.date_trunc("hour", "ts").cast("timestamp_ntz")).withColumn("batch_id", F.lit(0))
        return merge(placed.select("window_start", "user_id", "value", "event_id", "batch_id"))

    def job(stream: DataFrame, run: Run) -> None:
        jobs.keep_table(stream, run.table(schema, merge), newest, run.checkpoint)

    run = _feed(_events(t), _early(), "flush", job)
    kept = run.table(schema, merge).read(t.spark)
    ranked = windows.top_n_per(kept.withColumn("value", F.col("value") + 0.0), 5, "value", "user_id", ["window_start"])
    return windows.flush_lines(ranked, "user_id")


@query(
    """WITH placed AS (SELECT user_id, event_id, k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM (
      SELECT user_id, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, ts FROM events)),
    ends AS (SELECT user_id, unnest(generate_series(n // 5 - 1, n // 5)) AS window_no, k FROM placed)
    SELECT user_id, CAST(window_no AS BIGINT) AS window_no, count(*) AS cnt, CAST(sum(k) AS BIGINT) AS total FROM ends
    WHERE window_no >= 0 GROUP BY ALL HAVING count(*) = 10"""
)
def stream_sliding_count(t):
    schema = "user_id long, n long"
    merge = st.sum_by(["user_id"], ["n"])

    def job(stream: DataFrame, run: Run) -> None:
        table = run.table(schema, merge)
        jobs.sliding_count_windows(stream, table, run.out, 10, 5, "k", ["event_id"], ["user_id"], run.checkpoint)

    middle = t.events.agg(F.percentile_approx("event_id", 0.5).alias("m")).scalar()
    run = _feed(_events(t), F.col("event_id") <= middle, "slidingcount", job)
    return jobs.complete_sliding_windows(t.spark.read.parquet(run.out), 10, 5, ["user_id"])


@query(
    """WITH first AS (SELECT o_custkey AS id, CAST(min(o_orderkey) AS VARCHAR) AS "order" FROM orders GROUP BY 1)
    SELECT id, "order", c_name AS name, c_mktsegment AS segment FROM first JOIN customer ON c_custkey = id"""
)
def stream_single_join(t):
    """Three sources of different tables, joined on the customer as they come."""
    order = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderkey").cast("string").alias("value"))
    sides = {
        "order": order,
        "name": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("value")),
        "segment": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("value")),
    }
    rows = None
    for name, frame in sides.items():
        one = frame.select("id", F.lit(name).alias("side"), "value")
        rows = one if rows is None else rows.unionByName(one)
    schema = "id long, side string, value string"

    def job(stream: DataFrame, run: Run) -> None:
        table = run.table(schema, lambda df: df.select("id", "side", "value"))
        jobs.join_sides(stream, table, run.out, "id", "side", list(sides), "value", run.checkpoint)

    run = _feed(rows, (F.col("side") == "order") | (F.col("id") % 2 == 0), "join", job)
    return t.spark.read.parquet(run.out).select("id", *sides)


@query(
    """SELECT n // 5 AS bucket, count(*) AS n_keys FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1) GROUP BY 1"""
)
def stream_histogram(t):
    def job(stream: DataFrame, run: Run) -> None:
        jobs.kept_histogram(stream, _counted(run), _buckets(run), "user_id", 5, run.checkpoint)

    run = _feed(_events(t), _early(), "histogram", job)
    return _buckets(run).read(t.spark).where("n_keys > 0")


def _counted(run: Run) -> st.BatchTable:
    return run.table("user_id long, n long", st.sum_by(["user_id"], ["n"]))


def _buckets(run: Run) -> st.BatchTable:
    return st.BatchTable(f"{run.root}/histogram", "bucket long, n_keys long", st.sum_by(["bucket"], ["n_keys"]))
