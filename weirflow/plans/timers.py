"""Streams with timers and state that expires, and queries on the state of a stream. See ``streams`` for how they are fed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.operators.filters import words
from weirflow.plans.registry import Tables, query
from weirflow.plans.streams import ROLLED, Run, _early, _feed
from weirflow.plans.words import ASKED, COUNTS
from weirflow.streaming import jobs, timed

MIDDLE = "TIMESTAMP '2024-01-16 00:00:00'"


def _closed(rows: DataFrame, ts: str) -> DataFrame:
    """The rows, and one without a key that is later than all others by far."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != ts]
    return rows.unionByName(rows.agg((F.max(ts) + F.expr("interval 400 days")).alias(ts)).select(ts, *nothing))


@query(
    """WITH gaps AS (SELECT *, ts - lag(ts) OVER w >= INTERVAL 12 HOUR AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    lives AS (SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS life FROM gaps)
    SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n, arg_max(event_id, (ts, event_id)) AS event_id,
      arg_max(value, (ts, event_id)) AS value, max(ts) + INTERVAL 12 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AS expired
    FROM lives GROUP BY user_id, life"""
)
def ttl_state(t):
    """A store of each user's newest value: the keys that expired, and those that its state still holds."""

    def job(stream: DataFrame, run: Run) -> None:
        gone = timed.expiring_store(stream, "user_id", "ts", "event_id", "value", 12 * 3600, "1 hour")
        jobs.run_until_empty(gone, run.out, run.checkpoint)

    run = _feed(t.events.select("user_id", "ts", "event_id", "value"), _early(), "ttl-state", job)
    gone = t.spark.read.parquet(run.out).withColumn("expired", F.lit(True))
    held = timed.state_of(t.spark, run.checkpoint)
    return gone.unionByName(timed.held_values(held, "user_id", gone.schema).withColumn("expired", F.lit(False)))


@query(f"WITH {ROLLED} SELECT obj, cnt, window_end FROM rolled")
def timer_rolling_count(t):
    """Rolling counts of six hours that the running stream emits each hour."""

    def job(stream: DataFrame, run: Run) -> None:
        jobs.run_until_empty(timed.rolling_emissions(stream, "ts", "user_id", 6 * 3600, 3600, "1 minute"), run.out, run.checkpoint)

    run = _feed(_closed(t.events.select("user_id", "ts"), "ts"), _early(), "timer-rolling", job)
    return t.spark.read.parquet(run.out)


#: Three tables that share a key and have a time each, so that some keys miss a side or wait too long for one.
SIDES = {
    "event": "SELECT event_id AS id, ts, event_type AS value FROM {events}",
    "document": "SELECT doc_id, {at} + doc_id * INTERVAL 4 MINUTE + n_chars % 11 * INTERVAL 1 HOUR, lang FROM {documents}",
    "order": "SELECT o_orderkey, {at} + o_orderkey * INTERVAL 4 MINUTE + o_custkey % 7 * INTERVAL 1 HOUR, o_orderpriority FROM {orders}",
}


@query(
    "WITH rows AS ("
    + " UNION ALL ".join(f"SELECT *, '{s}' AS side FROM ({q.format(at='TIMESTAMP' + repr('2024-01-01'), events='events', documents='documents', orders='orders')})" for s, q in SIDES.items())
    + """),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, side) AS r, first_value(ts) OVER (PARTITION BY id ORDER BY ts, side) AS t1,
      nth_value(ts, 2) OVER (PARTITION BY id ORDER BY ts, side ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS t2 FROM rows),
    lives AS (SELECT *, CASE WHEN ts < t1 + INTERVAL 6 HOUR THEN 1 WHEN r = 2 OR t2 >= t1 + INTERVAL 6 HOUR AND ts < t2 + INTERVAL 6 HOUR THEN 2
      ELSE 3 END AS life FROM numbered)
    SELECT id, CASE WHEN count(*) = 3 THEN 'joined' ELSE 'expired' END AS status, min(ts) AS first_ts,
      max(value) FILTER (side = 'event') AS event, max(value) FILTER (side = 'document') AS document, max(value) FILTER (side = 'order') AS "order"
    FROM lives GROUP BY id, life"""
)
def stream_expiring_join(t):
    """Three sources joined on their key within six hours; what misses a side leaves to an output of its own."""
    events = t.events.select(F.col("event_id").alias("id"), "ts", F.lit("event").alias("side"), F.col("event_type").alias("value"))
    rows = events
    for side, frame, key, hours, value in (
        ("document", t.documents, "doc_id", "n_chars % 11", "lang"),
        ("order", t.orders, "o_orderkey", "o_custkey % 7", "o_orderpriority"),
    ):
        minutes = F.expr(f"{key} * 4 + ({hours}) * 60")
        at = F.timestamp_micros(F.expr("unix_micros(timestamp'2024-01-01')") + minutes * 60_000_000).cast("timestamp_ntz")
        rows = rows.unionByName(frame.select(F.col(key).alias("id"), at.alias("ts"), F.lit(side).alias("side"), F.col(value).alias("value")))

    def job(stream: DataFrame, run: Run) -> None:
        joined = timed.expiring_join(stream, "id", "side", list(SIDES), "ts", "value", 6 * 3600, "1 minute")
        jobs.run_until_empty(joined, run.out, run.checkpoint, by=["status"])

    run = _feed(_closed(rows, "ts"), _early(), "expiring-join", job)
    outputs = [t.spark.read.parquet(f"{run.out}/status={s}").withColumn("status", F.lit(s)) for s in ("joined", "expired")]
    return outputs[0].unionByName(outputs[1])


@query(f"WITH {COUNTS}, {ASKED} SELECT word, cnt FROM asked JOIN counts USING (word)")
def statestore_query(t: Tables):
    """Words answered from the state of a running aggregate, which has no table beside it."""

    def job(stream: DataFrame, run: Run) -> None:
        counted = timed.running_counts(words(stream, "text"), "word")
        writer = counted.writeStream.format("noop").outputMode("update").option("checkpointLocation", run.checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()

    run = _feed(t.documents.select("doc_id", "text"), F.col("doc_id") % 2 == 0, "live-words", job)
    return timed.live_counts(words(t.benchmark, "text"), run.checkpoint, "word")
