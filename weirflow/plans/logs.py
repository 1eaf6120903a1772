"""Log queries. Events are read as log entries and transactions, and written as log text to be parsed again."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import logs
from weirflow.plans.registry import Tables, query

K = "CAST(json_extract(props, '$.k') AS BIGINT)"


def _k():
    return F.get_json_object("props", "$.k").cast("long")


@query(
    """SELECT source, ts, id FROM (
      SELECT 'events' AS source, ts, event_id AS id FROM events
      UNION ALL SELECT 'errors', ts + INTERVAL 1 HOUR, event_id FROM events WHERE event_type = 'error')
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'"""
)
def log_merge(t):
    rows = t.events.select("ts", F.col("event_id").alias("id"))
    late = t.events.where("event_type = 'error'").select(
        F.expr("ts + interval 1 hour").alias("ts"), F.col("event_id").alias("id")
    )
    merged = logs.merged_log({"events": rows, "errors": late}, "ts", "2024-01-05 00:00:00", "2024-01-12 00:00:00")
    return logs.in_time_order(merged, "ts", "id")





@query(
    f"""WITH e AS (SELECT event_id, CAST(user_id AS VARCHAR) AS file, epoch_us(ts) // 1000 AS ts_ms, event_type, {K} AS k,
        strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' || lpad(CAST(epoch_us(ts) // 1000 % 1000 AS VARCHAR), 3, '0')
          || ' [myid:' || {K} % 3 || '] - ' || event_type AS head FROM events)
    SELECT file, CAST(row_number() OVER (PARTITION BY file ORDER BY event_id) AS BIGINT) AS record_no, ts_ms,
      CAST(coalesce(arg_min(k % 3, event_id) FILTER (k % 3 <> 0) OVER (PARTITION BY file), 0) AS INTEGER) AS node,
      CASE WHEN event_type = 'error' THEN head || chr(10) || 'java.io.IOException: ' || k || chr(10) || '  at ' || event_id
        ELSE head END AS log_text FROM e"""
)
def log_records(t):
    head = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" [myid:"), (_k() % 3).cast("string"), F.lit("] - "), "event_type"
    )
    trace = F.array(
        F.concat(F.lit("java.io.IOException: "), _k().cast("string")),
        F.concat(F.lit("  at "), F.col("event_id").cast("string")),
    )
    more = F.when(F.col("event_type") == "error", trace).otherwise(F.array().cast("array<string>"))
    lines = t.events.select(
        F.col("user_id").cast("string").alias("file"),
        F.col("event_id"),
        F.posexplode(F.concat(F.array(head), more)).alias("n", "value"),
    ).select("file", (F.col("event_id") * 4 + F.col("n")).alias("pos"), "value")
    return logs.assemble_records(lines)


def _entries(t: Tables):
    """Server log entries of five servers: what an event says depends on its type."""
    node = (F.col("user_id") % 5 + 1).cast("int")
    zxid = F.shiftleft(F.col("event_id").cast("long"), 30)
    text = (
        F.when(
            F.col("event_type") == "signup",
            F.concat(F.lit("peer - "), F.when(F.col("user_id") % 2 == 0, "LEADING").otherwise("FOLLOWING")),
        )
        .when(
            F.col("event_type") == "view",
            F.concat(F.lit("New election. My id =  "), node.cast("string"), F.lit(", Proposed zxid = "), zxid.cast("string")),
        )
        .when(
            F.col("event_type") == "click",
            F.concat(
                F.lit("Notification: 1 (n.leader), "),
                zxid.cast("string"),
                F.lit(" (n.zxid), 7 (n.round), LOOKING (n.state), "),
                (_k() % 5 + 1).cast("string"),
                F.lit(" (n.sid), LOOKING (my state)"),
            ),
        )
        .when(F.col("event_type") == "error", F.lit("java.lang.Exception at the server"))
        .otherwise(F.lit("plain"))
    )
    return t.events.select(
        F.col("event_id").alias("seq"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        node.alias("node"),
        text.alias("log_text"),
    )


LOG_EVENTS = f"""
e AS (SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts_ms, CAST(user_id % 5 + 1 AS INTEGER) AS node, event_type,
    user_id % 2 = 0 AS leads, event_id << 30 AS zxid, CAST((event_id << 30) >> 32 AS INTEGER) AS epoch,
    CAST(CASE WHEN ((event_id << 30) & 4294967295) >= 2147483648 THEN ((event_id << 30) & 4294967295) - 4294967296
      ELSE (event_id << 30) & 4294967295 END AS INTEGER) AS count,
    CAST({K} % 5 + 1 AS INTEGER) AS sid FROM events),
m AS (SELECT *, CASE WHEN event_type = 'signup' AND leads THEN node
    WHEN event_type IN ('view', 'click') AND epoch > 0 THEN 0 END AS mark FROM e),
l AS (SELECT *, last_value(mark IGNORE NULLS) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    AS leader FROM m),
seen AS (SELECT node AS dst, min(seq) AS first_seq FROM e GROUP BY 1),
log_events AS (
  SELECT 'stateChange' AS type, seq, ts_ms, node AS server, CASE WHEN leads THEN 'LEADING' ELSE 'FOLLOWING' END AS state,
    NULL::INTEGER AS src, NULL::INTEGER AS dst, NULL::BIGINT AS zxid, NULL::INTEGER AS count, NULL::INTEGER AS epoch,
    NULL::BIGINT AS epoch2, NULL::VARCHAR AS text FROM e WHERE event_type = 'signup'
  UNION ALL SELECT 'stateChange', seq, ts_ms, leader, 'INIT', NULL, NULL, NULL, NULL, NULL, NULL, NULL
    FROM l WHERE event_type IN ('view', 'click') AND epoch > 0 AND coalesce(leader, 0) <> 0
  UNION ALL SELECT 'postmessage', seq, ts_ms, NULL, NULL, node, dst, zxid, count, epoch, NULL, NULL
    FROM e JOIN seen ON first_seq <= seq AND dst <> node WHERE event_type = 'view'
  UNION ALL SELECT 'delivermessage', seq, ts_ms, NULL, NULL, sid, node, zxid, count, epoch, 7, NULL
    FROM e WHERE event_type = 'click' AND sid <> node
  UNION ALL SELECT 'exception', seq, ts_ms, node, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'java.lang.Exception at the server'
    FROM e WHERE event_type = 'error')"""


@query(f"WITH {LOG_EVENTS} SELECT * FROM log_events")
def log_events(t):
    return logs.log_events(_entries(t)).where("type <> 'text'")


@query(
    f"""WITH {LOG_EVENTS} SELECT src, dst, zxid FROM log_events p WHERE type = 'postmessage' AND NOT EXISTS (
      SELECT 1 FROM log_events d WHERE d.type = 'delivermessage' AND d.src = p.src AND d.dst = p.dst AND d.zxid = p.zxid)"""
)
def undelivered(t):
    return logs.undelivered(logs.log_events(_entries(t))).select("src", "dst", "zxid")


@query(
    """SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, min(ts) FILTER (event_type = 'signup') AS opened_ts,
      max(ts) FILTER (event_type = 'purchase') AS closed_ts, count(*) AS n FROM events GROUP BY 1"""
)
def session_span(t):
    return logs.session_spans(t.events, "user_id", "ts", "event_type", "signup", "purchase")


@query(
    """SELECT 'transaction' AS type, ts, lower(hex(user_id)) AS client_id, lower(hex(event_id)) AS cxid,
      lower(hex(event_id << 8)) AS zxid, event_type AS op, props AS extra FROM events"""
)
def transaction_events(t):
    txns = t.events.select(
        "ts",
        F.col("user_id").alias("client_id"),
        F.col("event_id").alias("cxid"),
        F.shiftleft("event_id", 8).alias("zxid"),
        F.col("event_type").alias("operation"),
        F.col("props").alias("extra"),
    )
    return logs.transaction_events(txns)
