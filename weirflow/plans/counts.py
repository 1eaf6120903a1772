"""Counts, windows and rankings over ``events`` in event order."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import aggregates as agg
from weirflow.operators import ordered, windows
from weirflow.plans.registry import query


@query(
    """SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS running_cnt
    FROM events"""
)
def running_count(t):
    return agg.running_count(t.events.select("event_id", "event_type"), ["event_type"], ["event_id"])


@query(
    """SELECT event_id, CAST(sum(user_id) OVER (ORDER BY event_id) AS BIGINT) AS running FROM events"""
)
def running_sum(t):
    return ordered.running_sum(t.events.select("event_id", "user_id"), "user_id", ["event_id"]).drop("user_id")


@query(
    """SELECT event_id, CAST(running AS BIGINT) AS running, CAST(sum(running) OVER (ORDER BY event_id) AS BIGINT) AS running2
    FROM (SELECT event_id, sum(user_id) OVER (ORDER BY event_id) AS running FROM events)"""
)
def running_sum2(t):
    return ordered.chained_running_sum(t.events.select("event_id", "user_id"), "user_id", ["event_id"]).drop("user_id")


@query(
    """SELECT user_id, event_id, k, expected FROM (
      SELECT user_id, event_id, k, coalesce(lag(k) OVER (PARTITION BY user_id ORDER BY event_id) + 1, 0) AS expected
      FROM (SELECT user_id, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events))
    WHERE k <> expected"""
)
def order_violations(t):
    rows = t.events.select("user_id", "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return ordered.order_violations(rows, "k", ["event_id"], ["user_id"]).drop("previous")


@query("SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) AS id FROM part")
def titles_index(t):
    return ordered.row_index(t.part.select("p_partkey", "p_name"), ["p_partkey"], name="id")


# --- windows by count ---------------------------------------------------------------------

NUMBERED = """numbered AS (SELECT event_type, user_id, event_id,
  row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events)"""


def _uses(t):
    return t.events.select("event_type", "user_id", "event_id")


@query(
    f"""WITH {NUMBERED} SELECT event_type, (n - 1) // 100 AS window_no, count(*) AS cnt,
      CAST(sum(user_id) AS BIGINT) AS total FROM numbered GROUP BY ALL HAVING count(*) = 100"""
)
def win_tumbling_count(t):
    aggs = [F.count(F.lit(1)).alias("cnt"), F.sum("user_id").alias("total")]
    return windows.tumbling_count(_uses(t), 100, ["event_id"], aggs, ["event_type"])


SLIDING = f"""{NUMBERED}, sums AS (SELECT event_type, n // 10 AS window_no, s AS window_sum, r AS window_rows FROM (
  SELECT event_type, n, sum(user_id) OVER w AS s, count(*) OVER w AS r FROM numbered
  WINDOW w AS (PARTITION BY event_type ORDER BY n ROWS 29 PRECEDING)) WHERE n % 10 = 0)"""


@query(f"WITH {SLIDING} SELECT event_type, window_no, CAST(window_sum AS BIGINT) AS window_sum, window_rows FROM sums")
def win_sliding_count(t):
    return windows.sliding_count_sum(_uses(t), "user_id", 30, 10, ["event_id"], ["event_type"])


@query(
    f"""WITH {SLIDING} SELECT event_type, (window_no - 1) // 3 AS average_no,
      CAST(sum(window_sum) AS BIGINT) // count(*) AS window_avg FROM sums GROUP BY ALL HAVING count(*) = 3"""
)
def win_sum_then_avg(t):
    return windows.sum_then_average(_uses(t), "user_id", 30, 10, 3, ["event_id"], ["event_type"])


@query(
    """WITH sums AS (SELECT n // 3 AS window_no, s FROM (
      SELECT event_id + 1 AS n, sum(user_id) OVER (ORDER BY event_id ROWS 4 PRECEDING) AS s FROM events) WHERE n % 3 = 0)
    SELECT window_no, CAST(s AS BIGINT) AS window_sum, CAST(sum(s) OVER (ORDER BY window_no) AS BIGINT) AS total
    FROM sums"""
)
def stateful_window_sum(t):
    total = windows.accumulated_window_sum(t.events.select("event_id", "user_id"), "user_id", 5, 3, ["event_id"])
    return total.drop("window_rows")


# --- windows by time ----------------------------------------------------------------------


@query(
    """SELECT event_type, time_bucket(INTERVAL 3 SECOND, ts) AS window_start,
      time_bucket(INTERVAL 3 SECOND, ts) + INTERVAL 3 SECOND AS window_end, count(*) AS cnt FROM events GROUP BY ALL"""
)
def win_tumbling_time(t):
    return windows.tumbling_time(t.events, "ts", 3, [F.count(F.lit(1)).alias("cnt")], ["event_type"])


def _sliding(length: int, slide: int) -> str:
    return f"""slid AS (SELECT event_type, window_start, window_start + INTERVAL {length} SECOND AS window_end,
      count(*) AS cnt FROM (
        SELECT event_type, unnest(list_transform(range({length // slide}), lambda i:
          time_bucket(INTERVAL {slide} SECOND, ts) - INTERVAL {slide} SECOND * i)) AS window_start FROM events)
      GROUP BY ALL)"""


@query(f"WITH {_sliding(6, 3)} SELECT * FROM slid")
def win_sliding_time(t):
    return windows.sliding_time_count(t.events, "ts", 6, 3, ["event_type"])


@query(
    f"""WITH {_sliding(3600, 1800)} SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY window_start ORDER BY cnt DESC, event_type) AS rank FROM slid) WHERE rank <= 3"""
)
def topn_per_window(t):
    counts = windows.sliding_time_count(t.events, "ts", 3600, 1800, ["event_type"])
    return windows.top_n_per(counts, 3, "cnt", "event_type", ["window_start"])


@query(
    """WITH slots AS (SELECT CAST(user_id AS VARCHAR) AS obj, epoch_us(ts) // 3600000000 AS pane FROM events),
    ends AS (SELECT obj, e, sum(c) AS cnt FROM (
      SELECT obj, unnest(range(pane + 1, pane + 8)) AS e, unnest([1, 1, 1, 1, 1, 1, 0]) AS c FROM slots) GROUP BY ALL)
    SELECT obj, CAST(cnt AS BIGINT) AS cnt, make_timestamp(e * 3600000000) AS window_end,
      CAST(least(6 * 3600, (e - (SELECT min(pane) FROM slots)) * 3600) AS BIGINT) AS window_seconds FROM ends"""
)
def rolling_count(t):
    uses = t.events.select(F.col("user_id").cast("string").alias("who"), "ts")
    return windows.rolling_count(uses, "ts", "who", 6 * 3600, 3600)


@query(
    """WITH last AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, user_id, arg_max(value, event_id) AS value
      FROM events GROUP BY ALL)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY value DESC, user_id) AS rank FROM last)
    WHERE rank <= 5"""
)
def topk_flush(t):
    return windows.top_k_flush(t.events, "ts", "user_id", "value", "event_id", 3600, 5)


# --- statistics ---------------------------------------------------------------------------


@query(
    """SELECT event_type, count(*) AS n, min(value) AS min_value, max(value) AS max_value,
      round(CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / count(*), 6) AS mean_value,
      round(stddev_pop(value), 6) AS stddev_value,
      round(quantile_cont(value, 0.99), 6) AS p99, round(quantile_cont(value, 0.999), 6) AS p999,
      round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0), 9) AS rate
    FROM events GROUP BY 1"""
)
def latency_summary(t):
    events = t.events.select("event_type", "value", "ts")
    span = windows.micros(F.max("ts")) - windows.micros(F.min("ts"))
    basic = events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.round(F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)), 6).alias("mean_value"),
        F.round(F.stddev_pop("value"), 6).alias("stddev_value"),
        F.round(F.count(F.lit(1)) / (span / 1000000.0), 9).alias("rate"),
    )
    tails = agg.exact_percentiles(events, ["event_type"], "value", [0.99, 0.999])
    return basic.join(
        tails.select("event_type", F.round("p0", 6).alias("p99"), F.round("p1", 6).alias("p999")), "event_type"
    )


@query("SELECT count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM events")
def num_events(t):
    return agg.num_events(t.events, "ts")


def _throughput(unit: str):
    sql = f"""SELECT date_trunc('{unit}', ms) AS bucket, count(*) AS cnt FROM (
      SELECT DISTINCT date_trunc('millisecond', ts) AS ms, event_id FROM events) GROUP BY 1"""
    short = {"second": "sec", "minute": "min", "hour": "hour"}[unit]
    query(sql, name=f"throughput_{short}")(lambda t: agg.throughput(t.events, "ts", "event_id", unit))


for _unit in ("second", "minute", "hour"):
    _throughput(_unit)


@query(
    """SELECT date_trunc('minute', ts) AS minute, date_trunc('hour', ts) AS hour, event_type, count(*) AS cnt,
      CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM events GROUP BY ALL"""
)
def rollup_minute(t):
    aggs = [
        F.count(F.lit(1)).alias("cnt"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
    ]
    return agg.rollup_minute(t.events, "ts", ["event_type"], aggs)
