"""Tables that a stream keeps up to date, exactly once.

Every micro-batch writes what it contributes to its own folder, named by its batch id, and replaces that
folder if the batch is run again. A reader merges the contributions. So a batch can fail at any point and be
repeated without counting twice, no value is updated in place, and a batch writes only as much as it brings.

``compact`` merges the folders so far into one. Its folder names the last batch it holds, and it counts only
when its write is complete, so a reader never sees half of it, and never sees a batch twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Merge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class BatchTable:
    """``merge`` folds rows of several batches (with the column ``batch_id``) into the state.

    It must give the same state when it is applied to its own results again; those carry the batch id of
    the last batch they hold.
    """

    path: str
    schema: str
    merge: Merge

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self, spark: SparkSession, before: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """The state after all batches, or after those before ``before``; with ``only``, of the keys it lists."""
        rows = self._rows(spark, before)
        if only is not None:
            rows = rows.join(only.distinct(), only.columns, "left_semi")
        return self.merge(rows)

    def batches(self, spark: SparkSession) -> list[int]:
        return sorted(number for kind, number in self._folders(spark) if kind == "batch")

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Merge all batches up to and including ``upto`` into one folder.

        Folders that an earlier merge made needless are removed. Those of this merge stay until the next, for
        readers that have begun with them.
        """
        folders = self._folders(spark)
        if ("base", upto) in folders:
            return
        state = self.merge(self._rows(spark, upto + 1))
        keep = [c for c in state.columns if c != "batch_id"]
        state.select(*keep).write.mode("overwrite").parquet(f"{self.path}/base={upto}")
        earlier = max((n for kind, n in folders if kind == "base" and n < upto), default=None)
        if earlier is not None:
            for kind, number in folders:
                if number < earlier or (kind, number) == ("batch", earlier):
                    path, files = self._file_system(spark)
                    files.delete(spark._jvm.org.apache.hadoop.fs.Path(path, f"{kind}={number}"), True)

    def forget(self, spark: SparkSession, before: int) -> None:
        """Remove the folders of batches before ``before``, for tables whose every batch is a whole state."""
        path, files = self._file_system(spark)
        for kind, number in self._folders(spark):
            if kind == "batch" and number < before:
                files.delete(spark._jvm.org.apache.hadoop.fs.Path(path, f"{kind}={number}"), True)

    def _rows(self, spark: SparkSession, before: int | None) -> DataFrame:
        folders = [(k, n) for k, n in self._folders(spark) if before is None or n < before]
        base = max((n for kind, n in folders if kind == "base"), default=None)
        used = [(k, n) for k, n in folders if (k == "base" and n == base) or (k == "batch" and (base is None or n > base))]
        # one listing and one scan per folder; compaction keeps them few
        frame = spark.createDataFrame([], f"{self.schema}, batch_id long")
        for kind, number in sorted(used, key=lambda f: f[1]):
            part = spark.read.schema(self.schema).parquet(f"{self.path}/{kind}={number}")
            frame = frame.unionByName(part.withColumn("batch_id", F.lit(number).cast("long")))
        return frame

    def _file_system(self, spark: SparkSession):
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _folders(self, spark: SparkSession) -> list[tuple[str, int]]:
        """The complete folders: those whose write left its success mark."""
        jvm = spark._jvm
        folder, files = self._file_system(spark)
        if not files.exists(folder):
            return []
        found = []
        for status in files.listStatus(folder):
            kind, _, number = status.getPath().getName().partition("=")
            done = files.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
            if kind in ("batch", "base") and number.isdigit() and done:
                found.append((kind, int(number)))
        return found


def sum_by(keys: Sequence[str], values: Sequence[str]) -> Merge:
    """Counters add up."""
    return lambda df: df.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])


def distinct_rows(columns: Sequence[str]) -> Merge:
    """A set of rows."""
    return lambda df: df.select(*columns).distinct()


def newest_by(keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> Merge:
    """The newest row of each key: by ``order``, then by batch."""

    def merge(df: DataFrame) -> DataFrame:
        rest = [c for c in columns if c not in keys]
        newest = F.max_by(F.struct(*rest), F.struct(*order, "batch_id")).alias("row")
        return df.groupBy(*keys).agg(newest).select(*keys, "row.*")

    return merge


def counters_and_columns(keys: Sequence[str], counters: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> Merge:
    """Keyed rows with counters that add up beside columns of which the newest value stays."""

    def merge(df: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(*columns), F.struct(*order, "batch_id")).alias("row")
        sums = [F.sum(c).alias(c) for c in counters]
        return df.groupBy(*keys).agg(*sums, newest).select(*keys, *counters, "row.*")

    return merge


def unexpired(table: DataFrame, written: str, ttl: str, as_of: str) -> DataFrame:
    """Rows of a keyed store that have not outlived ``ttl`` at the time ``as_of``."""
    return table.where(F.col(written) + F.expr(f"interval {ttl}") > F.expr(f"timestamp_ntz'{as_of}'"))


def query_state(requests: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Look up requested keys in the state; unknown keys give no row."""
    return requests.select(key).distinct().join(table, key)
