"""Tag uses, followers and features. A use is an event (user, event type, time); the ``k`` of an event's
properties is read as a follower of its user.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import aggregates as agg
from weirflow.operators import features, graph
from weirflow.plans.registry import Tables, query

K = "CAST(json_extract(props, '$.k') AS BIGINT)"
RELATIONS = f"relations AS (SELECT DISTINCT user_id, {K} AS follower FROM events)"


def _k():
    return F.get_json_object("props", "$.k").cast("long")


def relations(t: Tables):
    return t.events.select("user_id", _k().alias("follower")).distinct()


def uses(t: Tables):
    return t.events.select("user_id", F.col("event_type").alias("hashtag"), "ts")


def profiles(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey", "c_mktsegment", "c_acctbal")


@query(
    """SELECT user_id, hashtag, chunk_no, string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY event_id) AS uses FROM (
      SELECT user_id, event_type AS hashtag, event_id,
        (row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1) // 20 AS chunk_no FROM events)
    GROUP BY ALL"""
)
def tag_map(t):
    rows = t.events.select("user_id", F.col("event_type").alias("hashtag"), "event_id")
    lists = agg.chunked_lists(rows, ["user_id", "hashtag"], "event_id", 20)
    return lists.select("user_id", "hashtag", "chunk_no", F.array_join("items", " ").alias("uses"))


@query(
    f"""WITH {RELATIONS}, items AS (SELECT DISTINCT event_type || strftime(ts, '%d') AS item, user_id FROM events)
    SELECT item, count(DISTINCT follower) AS reach FROM items LEFT JOIN relations USING (user_id) GROUP BY item"""
)
def reach(t):
    items = t.events.select(F.concat("event_type", F.date_format("ts", "dd")).alias("item"), "user_id")
    return agg.reach(items, relations(t), "item", "user_id", "follower")


# --- the graph ----------------------------------------------------------------------------

FOLLOWS = f"""{RELATIONS}, people AS (SELECT DISTINCT user_id FROM events),
follows AS (SELECT user_id, follower FROM relations WHERE follower IN (SELECT user_id FROM people))"""


@query(
    f"""WITH {FOLLOWS} SELECT f.user_id, f.follower, a.c_name AS user_id_c_name, b.c_name AS follower_c_name
    FROM relations f JOIN customer a ON a.c_custkey = f.user_id JOIN customer b ON b.c_custkey = f.follower"""
)
def edges_resolve(t):
    from weirflow.operators.joins import resolve_edges

    return resolve_edges(relations(t), t.customer, "user_id", "follower", "c_custkey", "c_name")


def _vertices(t: Tables):
    return graph.vertices(t.events, "user_id", ["event_id"])


def _edges(t: Tables):
    return graph.edges(t.events, relations(t), "user_id", "follower", ["event_id"])


@query(
    """SELECT DISTINCT 'user:' || user_id AS id, 'user' AS kind FROM events
    UNION ALL SELECT 'use:' || event_id, 'use' FROM events"""
)
def graph_vertices(t):
    return _vertices(t)


@query(
    f"""WITH {FOLLOWS} SELECT 'user:' || user_id AS src, 'user:' || follower AS dst, 'follows' AS rel FROM follows
    UNION ALL SELECT 'user:' || user_id, 'use:' || event_id, 'tweeted' FROM events"""
)
def graph_edges(t):
    return _edges(t)


def _neighbour_sql(key: str, value: str) -> str:
    return f"""WITH {RELATIONS} SELECT id, chunk_no,
      string_agg(CAST(neighbour AS VARCHAR), ' ' ORDER BY neighbour) AS neighbours FROM (
        SELECT {key} AS id, {value} AS neighbour,
          (row_number() OVER (PARTITION BY {key} ORDER BY {value}) - 1) // 25 AS chunk_no FROM relations) GROUP BY ALL"""


def _neighbours(t: Tables, direction: str):
    pairs = relations(t).select(F.col("user_id").alias("src"), F.col("follower").alias("dst"))
    lists = graph.neighbours(pairs, direction, 25)
    return lists.select("id", "chunk_no", F.array_join("neighbours", " ").alias("neighbours"))


@query(_neighbour_sql("user_id", "follower"))
def neighbours_out(t):
    return _neighbours(t, "out")


@query(_neighbour_sql("follower", "user_id"))
def neighbours_in(t):
    return _neighbours(t, "in")


@query(
    f"""WITH {FOLLOWS} SELECT 'user:' || c_custkey AS id, 'user' AS kind FROM customer WHERE c_custkey IN (
      SELECT user_id FROM follows UNION SELECT follower FROM follows)"""
)
def non_isolated(t):
    everyone = t.customer.select(graph.user_id("c_custkey").alias("id"), F.lit("user").alias("kind"))
    return graph.without_isolated(everyone, _edges(t).where("rel = 'follows'"))


@query(
    f"""WITH {FOLLOWS} SELECT 'node' AS part, CAST(to_json({{'id': id, 'kind': kind}}) AS VARCHAR) AS value FROM (
      SELECT DISTINCT 'user:' || user_id AS id, 'user' AS kind FROM events
      UNION ALL SELECT 'use:' || event_id, 'use' FROM events)
    UNION ALL SELECT 'link', CAST(to_json({{'source': src, 'target': dst, 'rel': rel}}) AS VARCHAR) FROM (
      SELECT 'user:' || user_id AS src, 'user:' || follower AS dst, 'follows' AS rel FROM follows
      UNION ALL SELECT 'user:' || user_id, 'use:' || event_id, 'tweeted' FROM events)"""
)
def graph_json(t):
    return graph.graph_json(_vertices(t), _edges(t))


# --- features -----------------------------------------------------------------------------

FEATURES = f"""{RELATIONS},
profiles AS (SELECT c_custkey AS user_id, c_nationkey, c_mktsegment, c_acctbal FROM customer),
uses AS (SELECT user_id, event_type AS hashtag, ts FROM events WHERE user_id IN (SELECT user_id FROM profiles)),
people AS (SELECT DISTINCT user_id FROM uses),
pairs AS (SELECT user_id, follower FROM relations
  WHERE user_id IN (SELECT user_id FROM people) AND follower IN (SELECT user_id FROM people))"""
ANCHORED = f"""{FEATURES},
anchors AS (SELECT unnest(generate_series(date_trunc('day', min(ts)) + INTERVAL 1 DAY, date_trunc('day', max(ts)) + INTERVAL 1 DAY,
  INTERVAL 1 DAY)) AS anchor FROM events),
own AS (SELECT user_id, hashtag, anchor,
    count(*) FILTER (ts < anchor AND ts >= anchor - INTERVAL 1 DAY) AS label,
    count(*) FILTER (ts < anchor - INTERVAL 1 DAY AND ts > anchor - INTERVAL 4 DAY) AS num_tweets,
    bool_or(ts < anchor - INTERVAL 1 DAY) AS eligible
  FROM uses, anchors GROUP BY ALL),
theirs AS (SELECT p.user_id, o.hashtag, o.anchor, CAST(sum(o.num_tweets) AS BIGINT) AS num_user_relations
  FROM pairs p JOIN own o ON o.user_id = p.follower WHERE o.num_tweets > 0 GROUP BY ALL)"""


@query(
    f"""WITH {ANCHORED} SELECT own.user_id, own.hashtag, own.anchor, label, num_tweets,
      coalesce(num_user_relations, 0) AS num_user_relations, c_nationkey, c_mktsegment, c_acctbal
    FROM own LEFT JOIN theirs ON own.user_id = theirs.user_id AND own.hashtag = theirs.hashtag
      AND own.anchor = theirs.anchor JOIN profiles ON profiles.user_id = own.user_id WHERE eligible"""
)
def feature_training(t):
    return features.training_rows(uses(t), relations(t), profiles(t), features.Anchors.covering(uses(t)))


@query(f"WITH {ANCHORED} SELECT user_id, hashtag, anchor, num_user_relations FROM theirs")
def neighbour_window_counts(t):
    known, pairs = features.known_users(relations(t), uses(t), profiles(t), "user_id", "follower")
    anchors = features.Anchors.covering(uses(t))
    own = features.use_counts(known, "user_id", "hashtag", "ts", anchors)
    counts = features.neighbour_counts(own, pairs, "user_id", "follower", "hashtag")
    return counts.withColumn("anchor", anchors.time(F.col("anchor_no"))).drop("anchor_no")


@query(
    f"""WITH {FEATURES}, own AS (SELECT user_id, hashtag,
        count(*) FILTER (ts > TIMESTAMP '2024-01-25' - INTERVAL 3 DAY) AS num_tweets FROM uses GROUP BY ALL),
    theirs AS (SELECT p.user_id, o.hashtag, CAST(sum(o.num_tweets) AS BIGINT) AS num_user_relations
      FROM pairs p JOIN own o ON o.user_id = p.follower GROUP BY ALL)
    SELECT own.user_id, own.hashtag, TIMESTAMP '2024-01-25' AS anchor, num_tweets,
      coalesce(num_user_relations, 0) AS num_user_relations, c_nationkey, c_mktsegment, c_acctbal
    FROM own LEFT JOIN theirs USING (user_id, hashtag) JOIN profiles USING (user_id)"""
)
def feature_scoring(t):
    return features.scoring_rows(uses(t), relations(t), profiles(t), "2024-01-25 00:00:00")


@query(
    f"""WITH {FEATURES}, members AS (SELECT follower AS user_id FROM relations WHERE user_id = 8 UNION SELECT 8)
    SELECT user_id, 'click' AS hashtag, ts, c_nationkey, c_mktsegment, c_acctbal
    FROM uses JOIN profiles USING (user_id) WHERE hashtag = 'click' AND user_id IN (SELECT user_id FROM members)"""
)
def ego_dataset(t):
    return features.ego_rows(uses(t), relations(t), profiles(t), 8, "Click", "user_id", "follower", "hashtag")
