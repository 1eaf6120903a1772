"""The follower graph as a vertex table and an edge table.

Vertex ids are built from the type and the natural key, so they are the same in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.operators.aggregates import chunked_lists


def user_id(column: str) -> Column:
    return F.concat(F.lit("user:"), F.col(column).cast("string"))


def use_id(*columns: str) -> Column:
    return F.concat(F.lit("use:"), F.concat_ws(":", *[F.col(c).cast("string") for c in columns]))


def vertices(uses: DataFrame, user: str, use_key: list[str]) -> DataFrame:
    """A vertex for every user with a tag use, and one for every use."""
    people = uses.select(user_id(user).alias("id"), F.lit("user").alias("kind")).distinct()
    acts = uses.select(use_id(*use_key).alias("id"), F.lit("use").alias("kind")).distinct()
    return people.unionByName(acts)


def edges(uses: DataFrame, relations: DataFrame, user: str, follower: str, use_key: list[str]) -> DataFrame:
    """``follows`` edges (user to follower, both ends being users with a tag use) and ``tweeted`` edges."""
    people = uses.select(user).distinct()
    follows = (
        relations.select(user, follower)
        .distinct()
        .join(people, user, "left_semi")
        .join(people.withColumnRenamed(user, follower), follower, "left_semi")
        .select(user_id(user).alias("src"), user_id(follower).alias("dst"), F.lit("follows").alias("rel"))
    )
    tweeted = uses.select(
        user_id(user).alias("src"), use_id(*use_key).alias("dst"), F.lit("tweeted").alias("rel")
    ).distinct()
    return follows.unionByName(tweeted)


def neighbours(edge_table: DataFrame, direction: str, chunk: int = 1000, block: Column | None = None) -> DataFrame:
    """The neighbours of each vertex in lists of at most ``chunk`` ids; no vertex is cut short."""
    if direction not in ("out", "in"):
        raise ValueError("the direction must be 'out' or 'in'")
    key, value = ("src", "dst") if direction == "out" else ("dst", "src")
    pairs = edge_table.select(F.col(key).alias("id"), F.col(value).alias("neighbour")).distinct()
    return chunked_lists(pairs, ["id"], "neighbour", chunk, block, name="neighbours")


def without_isolated(vertex_table: DataFrame, edge_table: DataFrame) -> DataFrame:
    """Vertices that are an end of some edge."""
    ends = edge_table.select(F.col("src").alias("id")).unionByName(edge_table.select(F.col("dst").alias("id")))
    return vertex_table.join(ends, "id", "left_semi")


def graph_json(vertex_table: DataFrame, edge_table: DataFrame) -> DataFrame:
    """Nodes and links as JSON lines, one object per row, so that any number of files can hold them."""
    nodes = vertex_table.select(F.lit("node").alias("part"), F.to_json(F.struct("id", "kind")).alias("value"))
    links = edge_table.select(
        F.lit("link").alias("part"),
        F.to_json(F.struct(F.col("src").alias("source"), F.col("dst").alias("target"), "rel")).alias("value"),
    )
    return nodes.unionByName(links)
