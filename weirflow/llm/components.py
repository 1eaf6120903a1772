"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.session import scratch_path


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) for every node of (a, b): the label is the smallest node of its component.

    Large-star and small-star in turn: a node's larger neighbours, then its smaller ones, are hung on the smallest. Links
    only ever become shorter, so a component of any shape ends as a star after a few rounds. Each round is written.
    """
    spark = links.sparkSession

    def written(frame: DataFrame) -> DataFrame:
        path = scratch_path(spark, "links")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    both = F.explode(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    for _ in range(rounds):
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
        around = edges.select(both.alias("e")).select("e.a", "e.b")
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = written(small.select("e.a", "e.b").where("a <> b").distinct())
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
