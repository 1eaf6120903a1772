"""Projections, filters, joins, sets, ordering and SQL over the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.functions import predicates as p
from weirflow.functions.udfs import fold_in_order
from weirflow.operators import aggregates as agg
from weirflow.operators import filters, joins, sets
from weirflow.plans.registry import query

# --- projections and filters --------------------------------------------------------------


@query("SELECT c_custkey, c_name FROM customer")
def project(t):
    return t.customer.select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def filter_eq(t):
    return t.orders.where("o_orderstatus = 'P'").select("o_orderkey", "o_orderstatus")


@query("SELECT p_partkey, p_type FROM part WHERE lower(p_type) = lower('Economy')")
def eq_ignore_case(t):
    return filters.equal_ignoring_case(t.part, "p_type", "Economy").select("p_partkey", "p_type")


@query("SELECT event_id, event_type AS tag FROM events WHERE event_type IN ('click', 'view')")
def tracked_tags(t):
    uses = t.events.select("event_id", F.upper("event_type").alias("tag"))
    return filters.tracked(uses, "tag", ("Click", "view"))


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS piece FROM part")
def explode_list(t):
    listed = t.part.withColumn("pieces", F.split("p_name", " "))
    return filters.expand(listed, "pieces", "piece", ["p_partkey"])


@query("SELECT event_id, unnest([event_type, 'k' || json_extract_string(props, '$.k')]) AS entity FROM events")
def explode_entities(t):
    message = F.to_json(
        F.struct(
            F.array(
                F.struct(F.col("event_type").alias("text")),
                F.struct(F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("text")),
            ).alias("hashtags")
        )
    )
    parsed = t.events.select("event_id", F.from_json(message, "hashtags array<struct<text string>>").alias("m"))
    return filters.expand(parsed, "m.hashtags", "e", ["event_id"]).select("event_id", F.col("e.text").alias("entity"))


@query(
    """SELECT event_id, ts FROM events
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-05' + INTERVAL 3 DAY"""
)
def time_range(t):
    return filters.time_range(t.events, "ts", "2024-01-05 00:00:00", period="3 days").select("event_id", "ts")


# Predicates over events read as transactions: id, client, operation.


@query("SELECT event_id FROM events WHERE event_type = 'click' AND user_id < 75 AND value > 10")
def pred_and(t):
    keep = p.and_(F.col("event_type") == "click", F.col("user_id") < 75, F.col("value") > 10)
    return t.events.where(keep).select("event_id")


@query("SELECT event_id FROM events WHERE event_type = 'click' OR user_id = 10 OR user_id = 222")
def pred_or(t):
    keep = p.or_(F.col("event_type") == "click", F.col("user_id") == 10, F.col("user_id") == 0xDE)
    return t.events.where(keep).select("event_id")


@query("SELECT event_id FROM events WHERE NOT event_type = 'click'")
def pred_not(t):
    return t.events.where(p.not_(F.col("event_type") == "click")).select("event_id")


@query(
    """SELECT event_id FROM events WHERE CAST(event_type = 'click' AS INTEGER) + CAST(user_id < 75 AS INTEGER)
      + CAST(value > 10 AS INTEGER) = 1"""
)
def pred_xor(t):
    keep = p.xor_(F.col("event_type") == "click", F.col("user_id") < 75, F.col("value") > 10)
    return t.events.where(keep).select("event_id")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber = l_quantity AND l_quantity = 3")
def pred_eq_chain(t):
    keep = p.all_equal(F.col("l_linenumber"), F.col("l_quantity"), 3)
    return t.lineitem.where(keep).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT event_id FROM events WHERE value > user_id AND user_id > 2.5")
def pred_gt_chain(t):
    return t.events.where(p.decreasing(F.col("value"), F.col("user_id"), 2.5)).select("event_id")


@query("SELECT event_id FROM events WHERE 1 < user_id AND user_id < value")
def pred_lt_chain(t):
    return t.events.where(p.increasing(1, F.col("user_id"), F.col("value"))).select("event_id")


# --- joins --------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t):
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return t.orders.select("o_orderkey", "o_custkey").join(customers, "o_custkey")


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def join_semi(t):
    return joins.keep_known(t.documents.select("doc_id", "source"), t.labels.where("toxic = 1"), "doc_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def join_anti(t):
    return joins.drop_blocked(t.documents.select("doc_id", "source"), t.labels.where("toxic = 1"), "doc_id")


@query("SELECT doc_id, source, quality FROM documents LEFT JOIN labels USING (doc_id)")
def lookup_left(t):
    return joins.lookup(t.documents.select("doc_id", "source"), t.labels, "doc_id", ["quality"])


@query("SELECT doc_id, source, quality FROM documents JOIN labels USING (doc_id)")
def lookup_inner(t):
    return joins.lookup(t.documents.select("doc_id", "source"), t.labels, "doc_id", ["quality"], keep_misses=False)


@query(
    """WITH spent AS (SELECT o_custkey AS id, count(*) AS n_orders FROM orders GROUP BY 1)
    SELECT c_name, c_nationkey, n_orders FROM customer JOIN spent ON c_custkey = id"""
)
def single_join(t):
    names = t.customer.select(F.col("c_custkey").alias("id"), "c_name")
    homes = t.customer.select(F.col("c_custkey").alias("id"), "c_nationkey")
    spent = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("n_orders"))
    return joins.single_join([names, homes, spent], ["c_name", "c_nationkey", "n_orders"])


@query(
    """WITH v AS (SELECT user_id, event_id AS view_id, date_trunc('hour', ts) AS window_start FROM events
      WHERE event_type = 'view'),
    c AS (SELECT user_id, event_id AS click_id, date_trunc('hour', ts) AS window_start FROM events
      WHERE event_type = 'click')
    SELECT user_id, window_start, view_id, click_id FROM v JOIN c USING (user_id, window_start)"""
)
def window_join(t):
    views = t.events.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), "ts")
    clicks = t.events.where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), "ts")
    return joins.window_join(views, clicks, ["user_id"], "ts", 3600)


@query(
    """SELECT n_nationkey, n_name, n_regionkey, s_acctbal AS best FROM nation LEFT JOIN (
      SELECT s_nationkey, max(s_acctbal) AS s_acctbal FROM supplier GROUP BY 1) ON n_nationkey = s_nationkey"""
)
def lookup_nation(t):
    best = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.max("s_acctbal").alias("best"))
    return joins.lookup(t.nation, best, "n_nationkey", ["best"])


# --- sets, grouping, ordering -------------------------------------------------------------


@query("SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_all(t):
    return sets.union_all(
        t.customer.select(F.col("c_nationkey").alias("nationkey")),
        t.supplier.select(F.col("s_nationkey").alias("nationkey")),
    )


@query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t):
    return sets.union_distinct(
        t.customer.select(F.col("c_nationkey").alias("nationkey")),
        t.supplier.select(F.col("s_nationkey").alias("nationkey")),
    )


@query("SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY 1")
def sum_by_key(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query("SELECT CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem")
def global_sum(t):
    return t.lineitem.agg(F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query(
    """SELECT s_suppkey, round(s_acctbal / CAST(sum(CAST(s_acctbal AS DECIMAL(18, 2))) OVER () AS DOUBLE), 9) AS share
    FROM supplier"""
)
def l1_normalise(t):
    exact = t.supplier.select("s_suppkey", F.col("s_acctbal").cast("decimal(18,2)").alias("s_acctbal"))
    total = exact.agg(F.sum("s_acctbal").cast("double").alias("total"))
    return exact.select(
        "s_suppkey", F.round(F.col("s_acctbal").cast("double") / total.scalar(), 9).alias("share")
    )


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_pairs(t):
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query(
    """SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
    WHERE r = 1"""
)
def latest_per_key(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return agg.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r = 1"""
)
def one_per_key(t):
    return agg.one_per_key(t.orders.select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], ["o_orderkey"])


@query(
    """SELECT l_suppkey, chunk_no, string_agg(CAST(l_partkey AS VARCHAR), ' ' ORDER BY l_partkey) AS parts FROM (
      SELECT l_suppkey, l_partkey, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) - 1) // 50 AS chunk_no
      FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)) GROUP BY ALL"""
)
def group_list(t):
    pairs = t.lineitem.select("l_suppkey", "l_partkey").distinct()
    lists = agg.chunked_lists(pairs, ["l_suppkey"], "l_partkey", 50)
    return lists.select("l_suppkey", "chunk_no", F.array_join("items", " ").alias("parts"))


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey LIMIT 1")
def min_by_row(t):
    return agg.min_row(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), ["s_acctbal", "s_suppkey"])


@query("SELECT p_partkey, p_name, p_size FROM part ORDER BY p_size * p_retailprice DESC, p_partkey DESC LIMIT 1")
def max_by_row(t):
    nested = t.part.select("p_partkey", "p_name", "p_size", F.struct("p_size", "p_retailprice").alias("measures"))
    weight = F.col("measures.p_size") * F.col("measures.p_retailprice")
    return agg.max_row(nested, [weight, "p_partkey"]).drop("measures")


@query(
    """SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders
    GROUP BY 1 ORDER BY total DESC, o_custkey LIMIT 50"""
)
def topk_totals(t):
    exact = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    return t.orders.groupBy("o_custkey").agg(exact).orderBy(F.desc("total"), "o_custkey").limit(50)


def _slot_sql(key: str, slots: int) -> str:
    return f"CAST('0x' || left(md5(CAST({key} AS VARCHAR)), 8) AS BIGINT) % {slots}"


@query(f"SELECT o_orderkey, o_custkey FROM orders WHERE {_slot_sql('o_orderkey', 10)} < 1")
def sample_tenth(t):
    return filters.sample_by_key(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")


@query(
    f"""SELECT CAST(CASE WHEN {_slot_sql('o_orderkey', 10)} < 7 THEN 0 ELSE 1 END AS INTEGER) AS part, count(*) AS cnt
    FROM orders GROUP BY 1"""
)
def split_counts(t):
    parts = filters.split_by_key(t.orders.select("o_orderkey"), "o_orderkey", [7, 3])
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("cnt"))


@query("SELECT o_orderpriority, count(*) AS cnt FROM orders GROUP BY 1")
def repartition_by_key(t):
    spread = sets.spread(t.orders.select("o_orderkey", "o_orderpriority"), "partial_key", 8, ["o_orderpriority"])
    return agg.count_by(spread, "o_orderpriority")


@query(
    """SELECT l_orderkey, string_agg(l_returnflag || CAST(l_partkey AS VARCHAR), ''
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS folded
    FROM lineitem GROUP BY 1"""
)
def udaf_concat(t):
    piece = F.concat("l_returnflag", F.col("l_partkey").cast("string"))
    rows = t.lineitem.withColumn("piece", piece)
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return fold_in_order(rows, ["l_orderkey"], order, "piece", "".join)


# --- SQL ----------------------------------------------------------------------------------


def _sql_query(name: str, text: str, *tables: str) -> None:
    """Register one SQL text for both sides; on Spark the tables are temporary views with a prefix."""

    def build(t):
        for table in tables:
            getattr(t, table).createOrReplaceTempView(f"weirflow_{table}")
        return t.spark.sql(text.format(**{table: f"weirflow_{table}" for table in tables}))

    query(text.format(**{table: table for table in tables}), name=name)(build)


_sql_query(
    "sql_large_orders",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * l_quantity AS total
    FROM {lineitem} WHERE l_extendedprice * l_quantity > 1000000""",
    "lineitem",
)
_sql_query(
    "sql_group",
    "SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS best FROM {customer} GROUP BY c_mktsegment",
    "customer",
)
for _kind in ("inner", "left", "right", "full"):
    _sql_query(
        f"sql_join_{_kind}",
        f"""SELECT d.doc_id AS doc_id, l.quality, b.item_id FROM {{documents}} d
        {_kind.upper()} JOIN {{labels}} l ON d.doc_id = l.doc_id
        {_kind.upper()} JOIN {{benchmark}} b ON d.doc_id = b.item_id""",
        "documents",
        "labels",
        "benchmark",
    )
