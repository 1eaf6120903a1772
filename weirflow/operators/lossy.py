"""Heavy hitters by lossy counting (Manku and Motwani, 2002), as running values.

Rows come in buckets of ``width``. A key enters with count 1 and error bucket - 1, is counted up by
each further row, and is dropped at the end of a bucket when count + error <= bucket. Call the sum of
count and error the estimate E. A dropped key would come back with error bucket - 1, so after any row

    E = max(E before, bucket - 1) + 1

and unrolled, with c the running count of the key,

    E = c + (the largest of bucket - c over the key's rows so far).

That is a running count and a running maximum per key. There is no shared counter table to update in
turn, and a hot key is spread over blocks like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.operators.ordered import Fold, integral_block, prefix


def lossy_estimates(df: DataFrame, key: str, index: str, width: int, block_bits: int = 16) -> DataFrame:
    """The estimate after every row. ``index`` numbers all rows 1, 2, 3, …"""
    if width < 1:
        raise ValueError("the bucket width must be at least 1")
    block = integral_block(index, block_bits)
    rows = df.withColumn("bucket", F.expr(f"({index} - 1) div {width} + 1"))
    counted = prefix(rows, [index], {"__c": Fold("sum", F.lit(1).cast("long"))}, [key], block)
    lifted = prefix(counted, [index], {"__m": Fold("max", F.col("bucket") - F.col("__c"))}, [key], block)
    return lifted.withColumn("estimate", F.col("__c") + F.col("__m")).drop("__c", "__m")


def lossy_count(
    df: DataFrame, key: str, index: str, width: int, total: DataFrame | None = None, block_bits: int = 16, block: str | None = None
) -> DataFrame:
    """The keys still held after the last row: ``f`` (counted), ``delta`` (possible error), ``estimate``.

    With s the key's count before a row, the final estimate is the key's whole count plus the largest
    lift = bucket - 1 - s, and the key's present life began in the last bucket that reaches that lift. So
    each block of a key's rows is reduced to its count and its largest lift, and only those meet along the
    key. Rows of one bucket may be counted together first, since nothing is dropped inside a bucket.
    ``total`` is a one-row frame with the number of rows, if that is known more cheaply than by reading them.
    ``block`` is a column that does not decrease along the index; rows dealt by it alone are reduced where they are.
    """
    if width < 1:
        raise ValueError("the bucket width must be at least 1")
    total = df.agg(F.max(index).alias("n")) if total is None else total
    rows = df.withColumn("bucket", F.expr(f"({index} - 1) div {width} + 1"))
    if block:
        # a bucket's largest lift is that of its first row
        at = Window.partitionBy(key, "__block").orderBy(index)
        lifted = rows.select(key, F.col(block).alias("__block"), index, "bucket", F.lit(1).alias("__c"))
        lifted = lifted.withColumn("__lift", F.col("bucket") - F.row_number().over(at))
    else:
        blocked = rows.withColumn("__block", F.shiftright(F.col(index), block_bits))
        counts = blocked.groupBy(key, "__block", "bucket").agg(F.count(F.lit(1)).alias("__c"))
        before = Window.partitionBy(key, "__block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        lifted = counts.withColumn("__lift", F.col("bucket") - 1 - F.coalesce(F.sum("__c").over(before), F.lit(0)))
    blocks = (
        lifted.groupBy(key, "__block")
        .agg(F.sum("__c").alias("__c"), F.max(F.struct("__lift", "bucket")).alias("__top"))
    )
    earlier = Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    top = F.struct(F.col("__top.__lift") - F.coalesce(F.sum("__c").over(earlier), F.lit(0)), F.col("__top.bucket"))
    held = (
        blocks.select(key, "__c", top.alias("__top"))
        .groupBy(key)
        .agg(F.sum("__c").alias("__c"), F.max("__top").alias("__top"))
        .select(
            key,
            (F.col("__c") + F.col("__top.col1")).alias("estimate"),
            (F.col("__top.bucket") - 1).alias("delta"),
        )
    )
    complete = F.floor(total.scalar() / width).cast("long")
    return held.where(F.col("estimate") > complete).select(
        key, (F.col("estimate") - F.col("delta")).alias("f"), "delta", "estimate"
    )


def merge_shards(states: DataFrame, key: str, finished: DataFrame, shard: str) -> DataFrame:
    """Merge shard results. ``finished(shard, buckets)`` gives each shard's completed buckets.

    A shard that does not hold a key may have dropped up to ``buckets`` rows of it, so those count as
    error of the key.
    """
    missed = finished.agg(F.sum("buckets").alias("b"))
    held = states.join(finished, shard)
    merged = held.groupBy(key).agg(
        F.sum("f").alias("f"), F.sum("delta").alias("__delta"), F.sum("buckets").alias("__covered")
    )
    delta = F.col("__delta") + missed.scalar() - F.col("__covered")
    return merged.select(key, "f", delta.alias("delta"), (F.col("f") + delta).alias("estimate"))


def heavy_hitters_exact(df: DataFrame, keys: Sequence[str], support: float) -> DataFrame:
    """Keys with at least ``support`` of all rows, counted exactly."""
    total = df.agg(F.count(F.lit(1)).alias("n"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.where(F.col("cnt") >= total.scalar() * F.lit(support))
