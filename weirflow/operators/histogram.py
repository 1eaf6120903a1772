"""Log-linear histograms of latencies: three significant digits, a fixed number of buckets, and counts that add up.

Values below 2048 have a bucket each; above, every doubling is cut into 1024 buckets, so a bucket is never wider than a
thousandth of its values. Values above the bound of one hour count as the bound, negative ones as 0, and nulls not at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: One hour in microseconds.
BOUND = 3_600_000_000
HALF = 1024


def bucket(value: Column) -> Column:
    """The number of a value's bucket; larger values never have smaller numbers."""
    held = F.least(F.greatest(value.cast("long"), F.lit(0)), F.lit(BOUND))
    shift = F.greatest(F.floor(F.log2(F.greatest(held, F.lit(1)).cast("double"))) - 10, F.lit(0)).cast("int")
    return (shift * HALF + F.call_function("shiftright", held, shift)).cast("long")


def highest(number: Column) -> Column:
    """The largest value of a bucket."""
    shift = F.greatest(F.floor(number / HALF) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", number - shift * HALF + 1, shift) - 1


def histogram(df: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by, bucket, n). Counts of windows, tasks or batches are merged by adding them up."""
    counted = df.where(value.isNotNull()).groupBy(*by, bucket(value).alias("bucket"))
    return counted.agg(F.count(F.lit(1)).alias("n"))


def merged(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return counts.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def quantiles(counts: DataFrame, by: Sequence[str], shares: Mapping[str, int]) -> DataFrame:
    """(by, n, one column for each of ``shares``): the values that so many in 10,000 do not exceed.

    A group has at most some 23,000 buckets, so its buckets can be put in order in one task.
    """
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    upto = F.sum("n").over(group.orderBy("bucket"))
    placed = counts.select(*by, "bucket", "n", upto.alias("upto"), F.sum("n").over(group).alias("total"))
    # the smallest bucket that reaches the share, in whole numbers
    found = [F.min(F.when(F.col("upto") * 10_000 >= F.col("total") * share, highest(F.col("bucket")))).alias(name) for name, share in shares.items()]
    return placed.groupBy(*by).agg(F.sum("n").alias("n"), *found)
