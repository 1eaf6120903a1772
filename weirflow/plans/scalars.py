"""Scalar functions, one query per family."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.functions import scalars as fn
from weirflow.operators.logs import high_bits, log_time, low_bits
from weirflow.plans.registry import query


@query(
    r"""SELECT c_custkey, string_split(c_name, '#')[1] AS kind, string_split(c_name, '#')[2] AS number,
      CAST(len(list_filter(string_split('a::' || c_mktsegment || '::', ':'), lambda x: x <> '')) AS INTEGER) AS n_parts,
      array_to_string(regexp_split_to_array(c_mktsegment || '  x' || chr(9) || 'y', '\s+'), '|') AS by_space
    FROM customer"""
)
def scalar_split(t):
    name = F.split("c_name", "#")
    spaced = F.concat("c_mktsegment", F.lit("  x\ty"))
    return t.customer.select(
        "c_custkey",
        F.get(name, F.lit(0)).alias("kind"),
        F.get(name, F.lit(1)).alias("number"),
        F.size(fn.parts(F.concat(F.lit("a::"), "c_mktsegment", F.lit("::")), ":")).alias("n_parts"),
        F.array_join(F.split(spaced, r"\s+"), "|").alias("by_space"),
    )


@query(
    """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, substring(p_name, 2) AS rest,
      left(p_name, length(p_name) - 1) AS no_last, left(p_name || ' u', length(p_name || ' u') - 2) AS untagged,
      lower(p_type) AS low, upper(p_name) AS up, array_to_string(string_split(p_name, ' '), '+') AS joined,
      concat_ws(',', p_brand, p_type, CAST(p_size AS VARCHAR)) || ':' AS packed, contains(p_name, 'ring') AS has_ring
    FROM part"""
)
def scalar_strings(t):
    return t.part.select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.substr("p_name", F.lit(2)).alias("rest"),
        fn.drop_last("p_name").alias("no_last"),
        fn.drop_last(F.concat("p_name", F.lit(" u")), 2).alias("untagged"),
        F.lower("p_type").alias("low"),
        F.upper("p_name").alias("up"),
        F.array_join(F.split("p_name", " "), "+").alias("joined"),
        F.concat(F.concat_ws(",", "p_brand", "p_type", F.col("p_size").cast("string")), F.lit(":")).alias("packed"),
        F.col("p_name").contains("ring").alias("has_ring"),
    )


@query(
    r"""SELECT c_custkey, regexp_matches(c_name, '#0+[1-9]') AS padded,
      regexp_extract(c_name, '([A-Za-z]+)#0*(\d+)', 2) AS digits FROM customer"""
)
def scalar_regex(t):
    return t.customer.select(
        "c_custkey",
        F.col("c_name").rlike("#0+[1-9]").alias("padded"),
        F.regexp_extract("c_name", r"([A-Za-z]+)#0*(\d+)", 2).alias("digits"),
    )


@query(
    """SELECT event_id, CAST(CAST(user_id AS VARCHAR) AS INTEGER) AS as_int,
      CASE event_type WHEN 'click' THEN true ELSE false END AS lenient,
      user_id * 1000 AS as_long, CAST(CAST(value AS VARCHAR) AS DOUBLE) AS as_double FROM events"""
)
def scalar_casts(t):
    text = (
        F.when(F.col("event_type") == "click", "True").when(F.col("event_type") == "view", "False").otherwise("None")
    )
    return t.events.select(
        "event_id",
        F.col("user_id").cast("string").cast("int").alias("as_int"),
        fn.lenient_bool(text).alias("lenient"),
        fn.whole(F.concat((F.col("user_id") * 1000).cast("string"), F.lit(".0"))).alias("as_long"),
        F.col("value").cast("string").cast("double").alias("as_double"),
    )


@query(
    """SELECT o_orderkey, lower(hex(o_orderkey)) AS digits, CAST('0x' || lower(hex(o_orderkey)) AS BIGINT) AS back
    FROM orders"""
)
def scalar_hex(t):
    digits = fn.to_hex("o_orderkey")
    return t.orders.select(
        "o_orderkey", digits.alias("digits"), fn.from_hex(F.concat(F.lit("0x"), digits)).alias("back")
    )


@query(
    """WITH ids AS (SELECT event_id, (user_id << 32) | (event_id * 65537 & 4294967295) AS zxid FROM events)
    SELECT event_id, CAST(zxid >> 32 AS INTEGER) AS epoch,
      CAST(CASE WHEN (zxid & 4294967295) >= 2147483648 THEN (zxid & 4294967295) - 4294967296
        ELSE zxid & 4294967295 END AS INTEGER) AS counter FROM ids"""
)
def id_epoch_counter(t):
    low = (F.col("event_id") * 65537).bitwiseAND(F.lit(0xFFFFFFFF))
    ids = t.events.select("event_id", F.shiftleft("user_id", 32).bitwiseOR(low).alias("zxid"))
    return ids.select("event_id", high_bits("zxid").alias("epoch"), low_bits("zxid").alias("counter"))


@query(
    """SELECT p_partkey, p_partkey // 10 AS tenth, round(p_retailprice / 7) AS rounded, (p_partkey + 1) % 8 AS slot,
      greatest(p_size, 25) AS larger, least(p_size, 25) AS smaller,
      coalesce(nullif(p_size, 1), 0) AS filled, p_size * 2 > 50 AS big FROM part"""
)
def scalar_math(t):
    return t.part.select(
        "p_partkey",
        F.expr("p_partkey div 10").alias("tenth"),
        F.round(F.col("p_retailprice") / 7).alias("rounded"),
        fn.ring_slot("p_partkey", 8).alias("slot"),
        F.greatest("p_size", F.lit(25)).alias("larger"),
        F.least("p_size", F.lit(25)).alias("smaller"),
        F.coalesce(F.nullif("p_size", F.lit(1)), F.lit(0)).alias("filled"),
        (F.col("p_size") * 2 > 50).alias("big"),
    )


@query(
    """SELECT event_id, epoch_ms(date_trunc('second', ts)) AS api_ms, epoch_us(ts) // 1000 AS log_ms, CAST(0 AS BIGINT) AS bad_ms,
      epoch_us(ts) // 1000 - 259200000 AS three_days_before, date_trunc('minute', ts) AS minute,
      date_trunc('hour', ts) AS hour, strftime(ts, '%Y/%m/%d') AS folder, strftime(ts, '%Y%m%d%H%M%S') AS stamp
    FROM events"""
)
def scalar_dates(t):
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS")
    log_ms = log_time(stamp)
    api = F.concat(
        F.date_format("ts", "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format("ts", "yyyy")
    )
    return t.events.select(
        "event_id",
        fn.api_date_ms(api).alias("api_ms"),
        log_ms.alias("log_ms"),
        log_time(F.col("event_type")).alias("bad_ms"),
        fn.days_before(log_ms, 3).alias("three_days_before"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
        F.date_format("ts", "yyyy/MM/dd").alias("folder"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("stamp"),
    )


@query(
    """SELECT p_partkey, CAST(len(ws) AS INTEGER) AS n, ws[1] AS first, array_to_string(ws[2:], '+') AS rest,
      array_to_string(ws[1:1], '+') AS head, array_to_string(list_concat(ws, [p_brand]), '+') AS appended,
      array_to_string(list_concat(ws, ws), '+') AS doubled, list_contains(ws, 'ring') AS has_ring
    FROM (SELECT p_partkey, p_brand, string_split(p_name, ' ') AS ws FROM part)"""
)
def scalar_arrays(t):
    ws = F.col("ws")
    return t.part.select("p_partkey", "p_brand", F.split("p_name", " ").alias("ws")).select(
        "p_partkey",
        F.size(ws).alias("n"),
        F.get(ws, F.lit(0)).alias("first"),
        F.array_join(F.slice(ws, F.lit(2), F.size(ws)), "+").alias("rest"),
        F.array_join(F.slice(ws, 1, 1), "+").alias("head"),
        F.array_join(F.array_append(ws, F.col("p_brand")), "+").alias("appended"),
        F.array_join(F.concat(ws, ws), "+").alias("doubled"),
        F.exists(ws, lambda x: x == "ring").alias("has_ring"),
    )


@query(
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 2 ELSE 0 END AS clicks, 1 AS own, 2 AS n_keys FROM events"""
)
def scalar_maps(t):
    use = F.create_map("event_type", F.array("user_id", "event_id"))
    merged = F.map_concat(use, F.create_map(F.concat(F.lit("last:"), "event_type"), F.array("event_id")))
    clicks = F.coalesce(F.try_element_at(use, F.lit("click")), F.array().cast("array<bigint>"))
    return t.events.select(
        "event_id",
        F.size(clicks).alias("clicks"),
        F.size(F.element_at(merged, F.concat(F.lit("last:"), "event_type"))).alias("own"),
        F.size(F.map_keys(merged)).alias("n_keys"),
    )


@query(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
      json_extract_string(props, '$.k') AS k_text FROM events"""
)
def json_fields(t):
    return t.events.select(
        "event_id", F.from_json("props", "k int").getField("k").alias("k"), F.get_json_object("props", "$.k").alias("k_text")
    )


@query(
    """SELECT event_id, CAST(to_json({'user_id': user_id, 'event_type': event_type}) AS VARCHAR) AS doc FROM events"""
)
def json_render(t):
    return t.events.select("event_id", F.to_json(F.struct("user_id", "event_type")).alias("doc"))
