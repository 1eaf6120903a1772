"""User-defined functions: scalar, aggregate, table and whole-partition forms.

The Python forms move Arrow batches. They are for logic the built-in functions cannot express; the
operators of this package use built-in functions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf, udtf

from weirflow.operators.ordered import range_blocks


def register_scalar(spark: SparkSession, name: str, returns: str, function: Callable[..., pd.Series]) -> None:
    """Make a function over pandas series callable by name from SQL."""
    spark.udf.register(name, pandas_udf(function, returns))


def exclaim(values: pd.Series) -> pd.Series:
    return values + "!!!"


@udtf(returnType="word: string", useArrow=True)
class SplitWords:
    """One row per word of a sentence."""

    def eval(self, sentence: str):
        for word in (sentence or "").split(" "):
            if word:
                yield (word,)


def register_table_function(spark: SparkSession, name: str = "split_words", function=SplitWords) -> None:
    spark.udtf.register(name, function)


#: Characters of text, about, whose words a Python worker holds at once.
SPLIT_CHARS = 1 << 20


def python_split(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Split sentences at blanks in Python, a bounded run of sentences at a time."""

    def words(part: pa.RecordBatch) -> pa.RecordBatch:
        lists = pc.split_pattern(part.column(text).cast(pa.large_string()), " ")
        found = pc.list_flatten(lists).cast(pa.string())
        rows = pc.list_parent_indices(lists)
        given = pc.not_equal(found, "")
        rows = rows.filter(given)
        return pa.RecordBatch.from_arrays([*[part.column(c).take(rows) for c in keep], found.filter(given)], [*keep, "word"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            start = 0
            while start < batch.num_rows:
                # as many rows as fit, one at least
                end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + SPLIT_CHARS, "right")))
                yield words(batch.slice(start, end - start))
                start = end

    source = df.select(*keep, text)
    kept = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(split, f"{kept}, word string" if kept else "word string")


def fold_in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    fold: Callable[[pd.Series], str],
    block: Column | None = None,
) -> DataFrame:
    """A user aggregate ``init / add / result`` whose order matters: text is added up along ``order``.

    The values of a key are cut into pieces along the order, each piece is folded in Python, and the folded
    pieces are folded again. ``fold`` takes a series of texts and must be associative with "" as its neutral value, as
    concatenation is. Each key's result is one text, which grows with the key.
    Spark sorts the rows, and Python sees a run of equal keys as a stream, not as one group in memory.
    """

    def runs(names: list[str]):
        def fold_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = None
            for batch in (b for b in batches if len(b)):
                if held is not None:
                    batch = pd.concat([held, batch], ignore_index=True)
                keys = batch[names]
                same = (keys == keys.shift()) | (keys.isna() & keys.shift().isna())
                run = (~same.all(axis=1)).cumsum()
                done = keys.groupby(run).head(1).assign(__value=batch["__value"].groupby(run).agg(fold).to_numpy())
                held = done.tail(1)  # the run may go on in the next batch
                yield done.head(-1)
            if held is not None:
                yield held

        return fold_runs

    def folded(rows: DataFrame, names: list[str], by: Sequence[str]) -> DataFrame:
        schema = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in [*names, "__value"])
        placed = rows.repartition(*names).sortWithinPartitions(*names, *by)
        return placed.select(*names, "__value").mapInPandas(runs(names), schema)

    rows = df.select(*keys, *order, F.col(value).alias("__value"))
    if block is None:
        rows = range_blocks(rows, [*keys, *order], name="__piece")
    else:
        rows = df.select(*keys, block.alias("__piece"), *order, F.col(value).alias("__value"))
    parts = folded(rows, [*keys, "__piece"], order)
    return folded(parts, list(keys), ["__piece"]).withColumnRenamed("__value", "folded")
