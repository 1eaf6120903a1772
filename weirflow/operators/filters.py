"""Projections, filters and row-to-rows operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The tracked tags.
TRACKED_TAGS = (
    "politics", "funny", "win", "happybirthday", "metoo", "photography", "marvel", "pets", "friends", "science",
    "birthday", "tech", "technology", "fashion", "trump", "impeachdonaldtrump", "news", "fakenews", "family",
    "food", "summer", "usa", "love", "men", "women",
)
NO_FILTER = "NONE"


def non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.length(column) > 0)


def containing(df: DataFrame, column: str, term: str) -> DataFrame:
    """Rows whose text contains ``term``; the term "NONE" keeps every row."""
    return df if term == NO_FILTER else df.where(F.col(column).contains(term))


def equal_ignoring_case(df: DataFrame, column: str, value: str | Column) -> DataFrame:
    other = F.lit(value) if isinstance(value, str) else value
    return df.where(F.lower(column) == F.lower(other))


def tracked(df: DataFrame, column: str, tags: Sequence[str] = TRACKED_TAGS) -> DataFrame:
    """Rows whose tag, in lower case, is on the list; the tag is stored in lower case."""
    return df.withColumn(column, F.lower(column)).where(F.col(column).isin(*[tag.lower() for tag in tags]))


def words(df: DataFrame, text: str, name: str = "word", keep: Sequence[str] = ()) -> DataFrame:
    """One row per word: split at white space, lower case, no empty words."""
    split = df.select(*keep, F.explode(F.split(F.lower(F.col(text)), r"\s+")).alias(name))
    return split.where(F.col(name) != "")


def positioned_words(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """As ``words``, with ``pos`` counting the kept words of a text from 1."""
    kept = F.filter(F.split(F.lower(F.col(text)), r"\s+"), lambda w: w != "")
    return df.select(*keep, F.posexplode(kept).alias("p0", "word")).select(
        *keep, (F.col("p0") + 1).cast("long").alias("pos"), "word"
    )


def expand(df: DataFrame, column: str, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per list element; null and empty lists give none."""
    return df.select(*keep, F.explode(column).alias(name))


def time_range(df: DataFrame, ts: str, start: str | None = None, end: str | None = None, period: str | None = None):
    """Rows with ``start <= ts < end``. ``period`` (an interval such as '2 days') gives the end from the
    start. Without a start or an end that side is open, which is the same as the bound of the data.
    """
    if end is not None and period is not None:
        raise ValueError("give an end or a period, not both")
    if period is not None and start is None:
        raise ValueError("a period needs a start")
    if start is not None and end is not None and datetime.fromisoformat(end) < datetime.fromisoformat(start):
        raise ValueError("the end lies before the start")
    if start is not None:
        df = df.where(F.col(ts) >= F.expr(f"timestamp_ntz'{start}'"))
    if period is not None:
        df = df.where(F.col(ts) < F.expr(f"timestamp_ntz'{start}' + interval {period}"))
    elif end is not None:
        df = df.where(F.col(ts) < F.expr(f"timestamp_ntz'{end}'"))
    return df


def observed(df: DataFrame, name: str, *metrics: Column):
    """Watch rows in flight. Returns the frame and the Observation that holds the metrics after an action."""
    from pyspark.sql import Observation

    observation = Observation(name)
    return df.observe(observation, *(metrics or (F.count(F.lit(1)).alias("rows"),))), observation


def sample_by_key(df: DataFrame, key: str, tenths: int = 1) -> DataFrame:
    """A repeatable sample without replacement: rows whose key hashes into the first ``tenths`` of ten parts."""
    if not 0 <= tenths <= 10:
        raise ValueError("tenths must lie between 0 and 10")
    return df.where(_slot(key, 10) < tenths)


def _slot(key: str, slots: int) -> Column:
    """A number below ``slots`` from the MD5 of the key as text, which other systems give too."""
    return F.conv(F.left(F.md5(F.col(key).cast("string")), F.lit(8)), 16, 10).cast("long") % slots


def random_sample(df: DataFrame, fraction: float = 0.1, seed: int = 7) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def split_by_key(df: DataFrame, key: str, weights: Sequence[int]) -> DataFrame:
    """Label every row with the part it belongs to (column ``part``), in proportion to whole weights.

    The key decides, so the parts stay the same when the input is read or partitioned anew.
    """
    total = sum(weights)
    if total < 1 or min(weights) < 0:
        raise ValueError("weights must not be negative and must not all be 0")
    slot = _slot(key, total)
    part, upto = F.lit(None).cast("int"), total
    for index in reversed(range(len(weights))):
        part = F.when(slot < upto, F.lit(index)).otherwise(part)
        upto -= weights[index]
    return df.withColumn("part", part)
