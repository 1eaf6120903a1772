"""Running values over an ordered stream of rows, without putting one key into one task.

A plain ``Window.partitionBy(key).orderBy(seq)`` sorts all rows of a key in a single task, and
without a key it sorts the whole table there. Here the rows are cut into blocks along (key, order).
The blocks follow the rows: their borders are Spark's range borders, sampled from the rows
themselves, so a key with many rows gets many blocks and rows of many small keys share one, whatever the
type of the order and however its values lie. The blocks are folded first (a partial aggregate, so
only one row per key and block is shuffled), the folded blocks give every block its opening value,
and the opening value enters the block as its first row.

There are as many blocks as ``spark.sql.shuffle.partitions``; adaptive execution joins small ones.
An order of known density can bring its own blocks, which saves the range shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.session import scratch_path

BLOCK_BITS = 16
_BLOCK = "__block"
_ROW = "__row"


@dataclass(frozen=True)
class Fold:
    """One running value: ``kind`` is sum, max, min or last (the last value that is not null)."""

    kind: str
    value: Column

    def over(self, name: str, window) -> Column:
        column = F.col(name)
        if self.kind == "last":
            return F.last(column, ignorenulls=True).over(window)
        return _plain(self.kind)(column).over(window)

    def total(self, name: str, order: Sequence[str]) -> Column:
        column = F.col(name)
        if self.kind == "last":
            return F.max_by(column, F.when(column.isNotNull(), F.struct(*order)))
        return _plain(self.kind)(column)


def _plain(kind: str):
    functions = {"sum": F.sum, "max": F.max, "min": F.min}
    if kind not in functions:
        raise ValueError(f"unknown fold {kind!r}")
    return functions[kind]


def integral_block(order: str, bits: int = BLOCK_BITS) -> Column:
    """Blocks of 2**bits order values: at most that many rows each if the order is a unique integer."""
    return F.shiftright(F.col(order).cast("long"), bits)


def range_blocks(df: DataFrame, order: Sequence[str], blocks: int | None = None, name: str = "block") -> DataFrame:
    """Blocks of about equal numbers of rows along any columns.

    The borders are sampled, so the blocks are written out with the rows: a partition that is computed
    anew would otherwise be free to end elsewhere.
    """
    placed = df.repartitionByRange(blocks, *order) if blocks else df.repartitionByRange(*order)
    path = scratch_path(df.sparkSession, "blocks")
    placed.withColumn(name, F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def prefix(
    df: DataFrame,
    order: Sequence[str],
    folds: dict[str, Fold],
    keys: Sequence[str] = (),
    block: Column | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Add running values of ``folds`` for each key. ``order`` must be unique within a key.

    ``block`` must not decrease along the order of a key. It defaults to ranges of rows.
    With ``inclusive=False`` a row sees only the rows before it.
    """
    held = {f"__{name}": fold.value for name, fold in folds.items()}
    rows = df.withColumns(held)
    rows = range_blocks(rows, [*keys, *order], name=_BLOCK) if block is None else rows.withColumn(_BLOCK, block)

    totals = rows.groupBy(*keys, _BLOCK).agg(
        *[fold.total(f"__{name}", order).alias(f"__{name}") for name, fold in folds.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    opening = totals.select(
        *keys, _BLOCK, *[fold.over(f"__{name}", earlier).alias(f"__{name}") for name, fold in folds.items()]
    )

    together = rows.withColumn(_ROW, F.lit(1)).unionByName(
        opening.withColumn(_ROW, F.lit(0)), allowMissingColumns=True
    )
    within = (
        Window.partitionBy(*keys, _BLOCK)
        .orderBy(_ROW, *order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    return (
        together.withColumns({name: fold.over(f"__{name}", within) for name, fold in folds.items()})
        .where(F.col(_ROW) == 1)
        .drop(_ROW, _BLOCK, *held)
    )


def row_index(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    name: str = "row_no",
    block: Column | None = None,
) -> DataFrame:
    """Number the rows of each key 1, 2, 3, … in order."""
    return prefix(df, order, {name: Fold("sum", F.lit(1).cast("long"))}, keys, block)


def running_sum(df, value, order, keys=(), name="running", block=None) -> DataFrame:
    """Sum of ``value`` over the rows of the key up to and including this one."""
    return prefix(df, order, {name: Fold("sum", F.col(value))}, keys, block)


def chained_running_sum(df, value, order, keys=(), block=None) -> DataFrame:
    """A running sum (``running``) and the running sum of that (``running2``)."""
    first = running_sum(df, value, order, keys, "running", block)
    return running_sum(first, "running", order, keys, "running2", block)


def order_violations(df: DataFrame, seq: str, arrival: Sequence[str], keys: Sequence[str], block=None) -> DataFrame:
    """Rows whose sequence number is not one more than the row before; a key starts at 0."""
    seen = prefix(df, arrival, {"previous": Fold("last", F.col(seq))}, keys, block, inclusive=False)
    return seen.withColumn("expected", F.coalesce(F.col("previous") + 1, F.lit(0))).where(
        F.col(seq) != F.col("expected")
    )
