"""Aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.operators.ordered import Fold, prefix, row_index


def count_by(df: DataFrame, *keys: str | Column, name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def two_phase_count(df: DataFrame, key: str, salt_on: str, salts: int = 16, name: str = "cnt") -> DataFrame:
    """Count a skewed key in parts: first by key and salt, then the parts of each key.

    Batch counting is map-side combined anyway. This form also keeps a hot key apart where there is no
    map-side combine, as in a stateful stream or after a shuffle on the key.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(salt_on), F.lit(salts)))
    parts = salted.groupBy(key, "__salt").agg(F.count(F.lit(1)).alias("__part"))
    return parts.groupBy(key).agg(F.sum("__part").alias(name))


def l1_normalise(df: DataFrame, value: str, name: str) -> DataFrame:
    """Each value divided by the sum of all. The sum stays in the plan as a scalar subquery."""
    total = df.agg(F.sum(value).alias("total"))
    return df.withColumn(name, F.col(value) / F.nullif(total.scalar(), F.lit(0.0)))


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The row of each key that comes last by ``newest`` (add columns until there are no ties)."""
    return _extreme_row(df, keys, F.max_by, newest)


def one_per_key(df: DataFrame, keys: Sequence[str], stable: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``stable``, so that the choice is the same in every run."""
    return _extreme_row(df, keys, F.min_by, stable)


def min_row(df: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    return _extreme_row(df, (), F.min_by, by)


def max_row(df: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    return _extreme_row(df, (), F.max_by, by)


def _extreme_row(df, keys, pick, by) -> DataFrame:
    # an aggregate, unlike a row_number window, is combined before the shuffle and holds one row per key
    order = F.struct(*[(F.col(b) if isinstance(b, str) else b).alias(f"o{i}") for i, b in enumerate(by)])
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("__row"))
    return chosen.where(F.col("__row").isNotNull()).select(*keys, "__row.*")


def chunked_lists(
    df: DataFrame, keys: Sequence[str], value: str, chunk: int = 1000, block: Column | None = None, name: str = "items"
) -> DataFrame:
    """Each key's values in order, as lists of at most ``chunk`` values with a running ``chunk_no``.

    Nothing is left out: a key with many values gets many rows instead of one that grows without bound.
    ``value`` must be unique within a key.
    """
    numbered = row_index(df.select(*keys, value), [value], keys, "__n", block)
    return (
        numbered.withColumn("chunk_no", F.expr(f"(__n - 1) div {chunk}"))
        .groupBy(*keys, "chunk_no")
        .agg(F.array_sort(F.collect_list(value)).alias(name))
    )


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "running_cnt", block=None):
    """The count of the key after each row."""
    return row_index(df, order, keys, name, block)


def count_histogram(counts: DataFrame, count: str, width: int = 10) -> DataFrame:
    """How many keys fall into each bucket of counts."""
    bucket = F.expr(f"{count} div {width}").alias("bucket")
    return counts.groupBy(bucket).agg(F.count(F.lit(1)).alias("n_keys"))


def reach(tweeters: DataFrame, followers: DataFrame, item: str, tweeter: str, follower: str) -> DataFrame:
    """Distinct followers of everyone who passed an item on; an item nobody follows up counts 0.

    Both sides are made distinct before they meet, so repeated use of an item by one person costs nothing.
    """
    spread = tweeters.select(item, tweeter).distinct()
    pairs = spread.join(followers.select(tweeter, follower).distinct(), tweeter, "left")
    return pairs.groupBy(item).agg(F.countDistinct(follower).alias("reach"))


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, fractions: Sequence[float], block: Column | None = None
) -> DataFrame:
    """Interpolated percentiles per key as columns p0, p1, … in the order of ``fractions``.

    Spark's own exact percentile holds every distinct value of a group in one buffer. Here equal values
    are counted first, the counts are summed along the value order in blocks, and only the rows on both
    sides of a wanted rank are picked.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c"))
    summed = prefix(counted, [value], {"__upto": Fold("sum", F.col("__c"))}, keys, block)
    sizes = counted.groupBy(*keys).agg(F.sum("__c").alias("__size"))
    ranked = summed.join(sizes, list(keys)) if keys else summed.withColumn("__size", sizes.scalar())
    columns = []
    for index, fraction in enumerate(fractions):
        at = (F.col("__size") - 1) * F.lit(float(fraction))
        low, high = F.floor(at), F.ceil(at)

        def holds(rank):
            return (F.col("__upto") > rank) & (F.col("__upto") - F.col("__c") <= rank)

        v = F.col(value).cast("double")
        below, above = F.max(F.when(holds(low), v)), F.max(F.when(holds(high), v))
        share = F.max(at - low)
        # between equal values, infinite ones too, there is nothing to interpolate
        columns.append(F.when(above == below, below).otherwise(below + (above - below) * share).alias(f"p{index}"))
    return ranked.groupBy(*keys).agg(*columns)


def throughput(df: DataFrame, ts: str, ident: str, unit: str) -> DataFrame:
    """Per second, minute or hour: the sum over its milliseconds of the distinct ids in each."""
    if unit not in ("second", "minute", "hour"):
        raise ValueError("the unit must be second, minute or hour")
    distinct = df.select(F.date_trunc("millisecond", ts).cast("timestamp_ntz").alias("__ms"), ident).distinct()
    return distinct.groupBy(F.date_trunc(unit, "__ms").cast("timestamp_ntz").alias("bucket")).agg(
        F.count(ident).alias("cnt")
    )


def num_events(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def rollup_minute(df: DataFrame, ts: str, dims: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Aggregate per minute and dimensions, with the hour as the segment to partition files by."""
    minute = F.date_trunc("minute", ts).cast("timestamp_ntz").alias("minute")
    return (
        df.groupBy(minute, *dims).agg(*aggs).withColumn("hour", F.date_trunc("hour", "minute").cast("timestamp_ntz"))
    )
