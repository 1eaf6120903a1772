"""Windows by count and by time, and rankings inside them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.operators.ordered import Fold, prefix, row_index

def micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-free timestamp (session zone UTC)."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(column.cast("timestamp"))


def floor_div(value: str | Column, width: int) -> Column:
    """Whole-number division that rounds down, also below zero."""
    column = F.col(value) if isinstance(value, str) else value
    return F.call_function("div", column - F.pmod(column, F.lit(width)), F.lit(width))


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value).cast("timestamp_ntz")


def _positive(value: int) -> int:
    if value < 1:
        raise ValueError("a window length or slide must be at least 1")
    return value


def _copies(panes: DataFrame, low: Column, high: Column, name: str, gaps: bool) -> DataFrame:
    """A copy of each pane for every window it lies in. With gaps between windows it may lie in none."""
    bounded = panes.withColumns({"__lo": low, "__hi": high})
    if gaps:
        bounded = bounded.where("__lo <= __hi")
    return bounded.withColumn(name, F.explode(F.sequence("__lo", "__hi"))).drop("__lo", "__hi")


# --- windows by count ---------------------------------------------------------------------


def tumbling_count(
    df: DataFrame, size: int, order: Sequence[str], aggs: Sequence[Column], keys: Sequence[str] = (), block=None
) -> DataFrame:
    """Aggregate every ``size`` consecutive rows of a key; the incomplete rest fires nothing."""
    _positive(size)
    numbered = row_index(df, order, keys, "__n", block)
    return (
        numbered.withColumn("window_no", F.expr(f"(__n - 1) div {size}"))
        .groupBy(*keys, "window_no")
        .agg(*aggs, F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") == size)
        .drop("__rows")
    )


def sliding_count_sum(
    df: DataFrame,
    value: str,
    length: int,
    slide: int,
    order: Sequence[str],
    keys: Sequence[str] = (),
    block=None,
    name: str = "window_sum",
) -> DataFrame:
    """Sum of the last ``length`` rows each time ``slide`` more rows have come.

    Window ``window_no`` (from 1) ends at row ``window_no * slide``; the first ones hold fewer rows.
    Rows are summed into panes first, so a row is not copied once per window it falls in.
    """
    _positive(length), _positive(slide)
    pane = math.gcd(length, slide)
    per, span = slide // pane, length // pane
    panes = (
        row_index(df, order, keys, "__n", block)
        .withColumn("__pane", F.expr(f"(__n - 1) div {pane}"))
        .groupBy(*keys, "__pane")
        .agg(F.sum(value).alias("__sum"), F.count(F.lit(1)).alias("__rows"))
    )
    spread = _copies(panes, F.expr(f"__pane div {per} + 1"), F.expr(f"(__pane + {span}) div {per}"), "window_no", span < per)
    closing = F.col("__pane") == F.col("window_no") * per - 1
    return (
        spread.groupBy(*keys, "window_no")
        .agg(
            F.sum("__sum").alias(name),
            F.sum("__rows").alias("window_rows"),
            F.max(F.when(closing, F.col("__rows"))).alias("__last"),
        )
        .where(F.col("__last") == pane)
        .drop("__last")
    )


def sum_then_average(df, value, length, slide, per_average, order, keys=(), block=None) -> DataFrame:
    """Sliding sums, then the whole-number average of every ``per_average`` of them."""
    sums = sliding_count_sum(df, value, length, slide, order, keys, block)
    return (
        sums.withColumn("average_no", F.expr(f"(window_no - 1) div {per_average}"))
        .groupBy(*keys, "average_no")
        .agg(F.sum("window_sum").alias("__sum"), F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") == per_average)
        .select(*keys, "average_no", F.expr("__sum div __rows").alias("window_avg"))
    )


def accumulated_window_sum(df, value, length, slide, order, keys=(), block=None) -> DataFrame:
    """Add each firing's whole window sum to a total; rows in overlapping windows count again."""
    sums = sliding_count_sum(df, value, length, slide, order, keys, block)
    return prefix(sums, ["window_no"], {"total": Fold("sum", F.col("window_sum"))}, keys)


# --- windows by time ----------------------------------------------------------------------


def tumbling_time(df: DataFrame, ts: str, seconds: int, aggs: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """Aggregate by time window; columns ``window_start`` and ``window_end``."""
    _positive(seconds)
    return (
        df.groupBy(*keys, F.window(ts, f"{seconds} seconds").alias("__w"))
        .agg(*aggs)
        .withColumns({"window_start": F.col("__w.start"), "window_end": F.col("__w.end")})
        .drop("__w")
    )


def _panes(df, ts, seconds, aggs, keys) -> DataFrame:
    return df.groupBy(*keys, floor_div(micros(ts), seconds * 1_000_000).alias("__pane")).agg(*aggs)


def sliding_time_count(
    df: DataFrame, ts: str, length: int, slide: int, keys: Sequence[str] = (), name: str = "cnt"
) -> DataFrame:
    """Rows per key in windows of ``length`` seconds that start every ``slide`` seconds.

    Counting by pane first means a long window with a short slide copies pane totals, not rows.
    """
    _positive(length), _positive(slide)
    pane = math.gcd(length, slide)
    per, span = slide // pane, length // pane
    counted = _panes(df, ts, pane, [F.count(F.lit(1)).alias("__n")], keys)
    low, high = floor_div(F.col("__pane") - span, per) + 1, floor_div("__pane", per)
    spread = _copies(counted, low, high, "__start", span < per)
    start = F.col("__start") * (slide * 1_000_000)
    return (
        spread.groupBy(*keys, "__start")
        .agg(F.sum("__n").alias(name))
        .withColumns({"window_start": from_micros(start), "window_end": from_micros(start + length * 1_000_000)})
        .drop("__start")
    )


def rolling_count(df: DataFrame, ts: str, obj: str, length: int, emit: int) -> DataFrame:
    """Count per object in the last ``length`` seconds, emitted every ``emit`` seconds.

    An object whose count falls to zero is emitted once with 0 and then no more. Each pane adds its
    count to the ``length / emit`` windows it lies in and 0 to the one after, so a window that only
    holds that 0 is the closing row. ``window_seconds`` is shorter than ``length`` at the start.
    """
    counted = pane_counts(df, ts, obj, emit)
    return rolling_from_panes(counted, obj, length, emit)


def pane_counts(df: DataFrame, ts: str, obj: str, emit: int) -> DataFrame:
    """(obj, pane, n): the rows of each object in each ``emit`` seconds. Counts of several batches add up."""
    panes = _panes(df, ts, emit, [F.count(F.lit(1)).alias("n")], [obj])
    return panes.withColumnRenamed("__pane", "pane")


def rolling_from_panes(panes: DataFrame, obj: str, length: int, emit: int) -> DataFrame:
    """``rolling_count`` from the counts of panes."""
    slots = length // _positive(emit)
    if slots < 2:
        raise ValueError("the window must hold at least two slots")
    first = panes.agg(F.min("pane").alias("first"))
    ends = panes.withColumn("__end", F.explode(F.sequence(F.col("pane") + 1, F.col("pane") + slots + 1)))
    inside = F.col("__end") <= F.col("pane") + slots
    emitted = ends.groupBy(obj, "__end").agg(F.sum(F.when(inside, F.col("n")).otherwise(0)).alias("cnt"))
    return emitted.select(
        F.col(obj).alias("obj"),
        "cnt",
        from_micros(F.col("__end") * (emit * 1_000_000)).alias("window_end"),
        F.least(F.lit(slots * emit).cast("long"), (F.col("__end") - first.scalar()) * emit).alias("window_seconds"),
    )


# --- rankings -----------------------------------------------------------------------------


def top_n(df: DataFrame, n: int, count: str, obj: str, keep: Sequence[str] = ()) -> DataFrame:
    """The ``n`` largest counts with their rank; ties go by object, zero counts do not rank."""
    if n < 1:
        raise ValueError("n must be at least 1")
    best = (
        df.where(F.col(count) > 0)
        .select(obj, count, *keep)
        .orderBy(F.col(count).desc(), F.col(obj))
        .limit(n)
    )
    # n rows are left here, so one ordered task is enough to number them
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.col(count).desc(), obj)).cast("long"))


def top_n_per(df: DataFrame, n: int, count: str, obj: str, keys: Sequence[str]) -> DataFrame:
    """The ``n`` largest counts of each group, ranked in parts first."""
    if n < 1:
        raise ValueError("n must be at least 1")
    return _ranked(df.where(F.col(count) > 0), n, count, obj, keys)


def _ranked(df: DataFrame, n: int, value: str, obj: str, keys: Sequence[str]) -> DataFrame:
    """The ``n`` first rows of each group by falling value, then by object.

    A group is dealt into as many parts as there are shuffle partitions, and only the n first of each part meet. Spark
    alone would cut before the shuffle for small n only, and sort a whole group in one task for others.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(obj), F.lit(parts))
    order = (F.col(value).desc(), F.col(obj))
    first = F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(*order))
    best = df.withColumn("__part", part).withColumn("__first", first).where(F.col("__first") <= n).drop("__part", "__first")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
    return best.withColumn("rank", rank).where(F.col("rank") <= n)


def top_k_flush(df: DataFrame, ts: str, key: str, value: str, order: str, seconds: int, k: int = 100) -> DataFrame:
    """Per flush window: the last value of each key, and of those the ``k`` largest."""
    start = F.window(ts, f"{seconds} seconds")
    last = df.groupBy(start.alias("__w"), key).agg(F.max_by(value, order).alias(value))
    flat = last.select(F.col("__w.start").alias("window_start"), key, value)
    return _ranked(flat, k, value, key, ["window_start"])


def flush_lines(ranked: DataFrame, key: str) -> DataFrame:
    """One text line per flush: the window start and the keys in rank order, each in angle brackets.

    The list is bounded by the k of the ranking.
    """
    pairs = F.array_sort(F.collect_list(F.struct("rank", F.col(key).cast("string").alias("k"))))
    tags = F.transform(pairs, lambda p: F.concat(F.lit("<"), p["k"], F.lit(">")))
    stamp = F.concat(F.lit("<"), F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"), F.lit(">"))
    return ranked.groupBy("window_start").agg(tags.alias("tags")).select(
        F.concat(stamp, F.array_join("tags", "")).alias("value")
    )
