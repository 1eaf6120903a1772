"""Link analysis. A line item is a link from its part's page to its supplier's page; pages share one range
of ids and are titled by part name.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import hits as h
from weirflow.plans.registry import Tables, query
from weirflow.sources import readers

ROUNDS = 5
EDGES = "edges AS (SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem)"


def edges(t: Tables):
    return t.lineitem.select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")).distinct()


def titles(t: Tables):
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))


def _unrolled(rule: str) -> str:
    """The rounds as one chain of table expressions."""
    steps = [EDGES, "h0 AS (SELECT DISTINCT src AS id, CAST(1 AS DOUBLE) AS s FROM edges)"]
    for n in range(1, ROUNDS + 1):
        before = f"h{n - 1}" if rule == "hub" or n == 1 else f"a{n - 1}"
        steps.append(
            f"""a{n} AS MATERIALIZED (SELECT id, s / sum(s) OVER () AS s FROM (
              SELECT dst AS id, sum(s) AS s FROM edges JOIN {before} ON src = id GROUP BY dst))"""
        )
        steps.append(
            f"""h{n} AS MATERIALIZED (SELECT id, s / sum(s) OVER () AS s FROM (
              SELECT src AS id, sum(s) AS s FROM edges JOIN a{n} ON dst = id GROUP BY src))"""
        )
    return "WITH " + ", ".join(steps)


def _rounded(scores):
    return scores.select("id", F.round("score", 9).alias("score"))


@query(f"{_unrolled('hub')} SELECT id, round(s, 9) AS score FROM a{ROUNDS}")
def hits_auth(t):
    return _rounded(h.hits(edges(t), ROUNDS)[0])


@query(f"{_unrolled('hub')} SELECT id, round(s, 9) AS score FROM h{ROUNDS}")
def hits_hub(t):
    return _rounded(h.hits(edges(t), ROUNDS)[1])


@query(f"{_unrolled('authority')} SELECT id, round(s, 9) AS score FROM a{ROUNDS}")
def power_iteration(t):
    return _rounded(h.hits(edges(t), ROUNDS, update="authority")[0])


@query(
    f"""{_unrolled('hub')} SELECT id, p_name AS title, score FROM (
      SELECT id, round(s, 6) AS score FROM a{ROUNDS}) JOIN part ON p_partkey = id ORDER BY score DESC, id LIMIT 50"""
)
def topk_scores(t):
    scores = h.hits(edges(t), ROUNDS)[0].select("id", F.round("score", 6).alias("score"))
    return h.top_scores(scores, 50).join(titles(t), "id")


@query(
    """WITH root AS (SELECT p_partkey AS id FROM part WHERE contains(p_name, 'ring')),
    edges AS (SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem),
    base AS (SELECT id FROM root UNION SELECT dst FROM edges WHERE src IN (SELECT id FROM root)
      UNION SELECT src FROM edges WHERE dst IN (SELECT id FROM root))
    SELECT p_partkey AS id, p_name AS title, contains(p_name, 'ring') AS in_root FROM part
    WHERE p_partkey IN (SELECT id FROM base)"""
)
def hits_base_set(t):
    return h.base_set(edges(t), titles(t), "ring")


@query(
    """SELECT src, dst, a.p_name AS src_title, b.p_name AS dst_title
    FROM (SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem)
    JOIN part a ON a.p_partkey = src JOIN part b ON b.p_partkey = dst WHERE contains(b.p_name, 'ring')"""
)
def edge_titles(t):
    return h.titled_edges(edges(t), titles(t), "ring")


@query("SELECT p_partkey AS id, p_name AS title FROM part WHERE contains(p_name, 'ring')")
def title_contains(t):
    from weirflow.operators.filters import containing

    return containing(titles(t), "title", "ring")


@query(
    """SELECT l_orderkey AS src, unnest([l_partkey, l_suppkey]) AS dst FROM lineitem"""
)
def links_parse(t):
    number = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey")]
    line = F.concat(number[0], F.lit(": "), number[1], F.lit("  "), number[2])
    return readers.parse_links(t.lineitem.select(line.alias("value")))


@query(
    """SELECT 'u' || user_id AS screen_name, event_type AS hashtag, CASE WHEN event_id % 3 > 0 THEN 9007199254740993 + event_id END AS ts_ms,
      1 AS quote_count, 2 AS reply_count, 3 AS retweet_count, CAST(user_id AS INTEGER) AS favorite_count,
      true AS favorited, false AS retweeted, 'low' AS filter_level FROM events"""
)
def pair_text_parse(t):
    fields = F.concat_ws(
        " ", "event_type", F.when(F.col("event_id") % 3 > 0, (F.col("event_id") + 9007199254740993).cast("string")).otherwise("None"), F.lit("1 2 3"),
        F.col("user_id").cast("string"), F.lit("True None low"),
    )
    stored = F.concat(F.lit("(u"), F.col("user_id").cast("string"), F.lit(","), fields, F.lit(")"))
    return readers.parse_tag_uses(t.events.select(stored.alias("value")))


@query(
    """SELECT 'u' || user_id AS screen_name, unnest(['f' || event_id, 'g' || event_id]) AS follower FROM events"""
)
def packed_records(t):
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    line = F.concat(
        F.lit("u"), user, F.lit(",f"), event, F.lit(":u"), user, F.lit(",g"), event, F.lit(":")
    )
    return readers.wire_relations(t.events.select(line.alias("value")))
