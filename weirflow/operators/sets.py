"""Unions, and how rows are spread over tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def spread(df: DataFrame, how: str, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """Repartition: ``shuffle`` evenly, ``fields`` by key, ``partial_key`` by key with a hot key cut to
    tasks of the advisory size, ``global`` to one task (for small results only).
    """
    if how == "shuffle":
        return df.repartition(n)
    if how == "fields":
        return df.repartition(n, *keys)
    if how == "partial_key":
        return df.hint("rebalance", n, *keys)
    if how == "global":
        return df.coalesce(1)
    raise ValueError(f"unknown way to spread rows: {how!r}")
