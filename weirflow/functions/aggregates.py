"""User aggregates called by name from SQL.

An aggregate is four functions: the state at the start, adding a batch of values to it, merging two states, and the result. Three
names are registered: ``f`` folds a group in one go, ``f_part`` gives the state of a piece of a group and ``f_total`` merges
such states into the result, so that a hot group is folded in pieces that many tasks share:

    SELECT k, f_total(part) FROM (SELECT k, f_part(x, y) AS part FROM t GROUP BY k, piece) GROUP BY k
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import PandasUDFType, pandas_udf


def register_aggregate(
    spark: SparkSession,
    name: str,
    returns: str,
    init: Callable[[], Any],
    add: Callable[..., Any],
    merge: Callable[[Any, Any], Any],
    result: Callable[[Any], Any],
) -> None:
    """Register ``name``, ``name_part`` and ``name_total``. A state is anything JSON can hold."""

    def whole(*columns: pd.Series):
        return result(add(init(), *columns))

    def part(*columns: pd.Series) -> str:
        return json.dumps(add(init(), *columns))

    def total(states: pd.Series):
        return result(functools.reduce(merge, map(json.loads, states.dropna()), init()))

    for suffix, function, kind in (("", whole, returns), ("_part", part, "string"), ("_total", total, returns)):
        spark.udf.register(name + suffix, pandas_udf(function, kind, PandasUDFType.GROUPED_AGG))


def weighted_mean(spark: SparkSession, name: str = "weighted_mean") -> None:
    """``weighted_mean(value, weight)``: null without weight; rows with a null are left out."""

    def add(state, values, weights):
        values, weights = values.astype("float64"), weights.astype("float64")
        used = values.notna() & weights.notna()
        return [state[0] + float((values * weights)[used].sum()), state[1] + float(weights[used].sum())]

    register_aggregate(
        spark, name, "double", lambda: [0.0, 0.0], add, lambda a, b: [a[0] + b[0], a[1] + b[1]], lambda s: s[0] / s[1] if s[1] else None
    )
