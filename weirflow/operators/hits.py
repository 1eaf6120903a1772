"""Hub and authority scores of a link graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.operators.aggregates import l1_normalise
from weirflow.session import shared_dir

CHECKPOINT_EVERY = 3


def _pass_on(edges: DataFrame, scores: DataFrame, source: str, target: str) -> DataFrame:
    """Sum over each target the scores of its sources. The sum is combined before the shuffle by target."""
    return (
        edges.join(scores.withColumnRenamed("id", source), source)
        .groupBy(F.col(target).alias("id"))
        .agg(F.sum("score").alias("score"))
    )


def hits(
    edges: DataFrame, rounds: int = 5, update: str = "hub", checkpoint_every: int = CHECKPOINT_EVERY
) -> tuple[DataFrame, DataFrame]:
    """Authority and hub scores ``(id, score)`` of distinct edges ``(src, dst)``, each with sum 1.

    ``update="hub"`` is the textbook rule: authorities from hubs, hubs from authorities. With
    ``update="authority"`` a round makes the authorities from the last authorities, that is a power
    iteration, with hubs derived from them.

    A round is linear in its input, so scaling can wait: scores are brought back to sum 1 when they are
    checkpointed, every few rounds, and at the end. Between checkpoints nothing is computed twice.
    """
    if rounds < 1:
        raise ValueError("at least one round is needed")
    if update not in ("hub", "authority"):
        raise ValueError("update must be 'hub' or 'authority'")
    shared_dir(edges.sparkSession)
    # read twice in every round, so written once
    edges = edges.select("src", "dst").checkpoint()
    carried = edges.select(F.col("src").alias("id")).distinct().withColumn("score", F.lit(1.0))
    authorities = hubs = carried
    for number in range(1, rounds + 1):
        authorities = _pass_on(edges, carried, "src", "dst")
        last = number == rounds
        if update == "authority":
            carried = authorities
        else:
            # the hub scores start from the same authorities twice at the end: once to return, once to derive
            authorities = authorities.checkpoint() if last else authorities
            hubs = carried = _pass_on(edges, authorities, "dst", "src")
        if not last and number % checkpoint_every == 0:
            carried = _normal(carried.checkpoint())
    if update == "authority":
        authorities = authorities.checkpoint()
        hubs = _pass_on(edges, authorities, "dst", "src")
    return _normal(authorities), _normal(hubs.checkpoint())


def _normal(scores: DataFrame) -> DataFrame:
    return l1_normalise(scores, "score", "score")


def top_scores(scores: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` highest scores, ties by id."""
    return scores.orderBy(F.col("score").desc(), F.col("id")).limit(k)


def titled_edges(edges: DataFrame, titles: DataFrame, term: str = "NONE") -> DataFrame:
    """Edges between known pages, with both titles; only those whose target title contains ``term``."""
    source = titles.select(F.col("id").alias("src"), F.col("title").alias("src_title"))
    target = titles.select(F.col("id").alias("dst"), F.col("title").alias("dst_title"))
    if term != "NONE":
        target = target.where(F.col("dst_title").contains(term))
    return edges.join(source, "src").join(target, "dst")


def base_set(edges: DataFrame, titles: DataFrame, term: str) -> DataFrame:
    """The pages whose title contains ``term`` and the pages that link to them or are linked from them."""
    root = titles.where(F.col("title").contains(term)).select("id")
    outward = edges.join(root.withColumnRenamed("id", "src"), "src", "left_semi").select(F.col("dst").alias("id"))
    inward = edges.join(root.withColumnRenamed("id", "dst"), "dst", "left_semi").select(F.col("src").alias("id"))
    members = root.unionByName(outward).unionByName(inward).distinct()
    return titles.join(members, "id", "left_semi").withColumn("in_root", F.col("title").contains(term))


def root_edges(edges: DataFrame, titles: DataFrame, term: str) -> DataFrame:
    """Edges whose source page is in the root set."""
    root = titles.where(F.col("title").contains(term)).select(F.col("id").alias("src"))
    return edges.join(root, "src", "left_semi")


