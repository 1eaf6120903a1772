"""Log files with a zone map: the smallest and largest time of every file, kept beside the files, so that a range of time opens
only the files that can hold some of it.

A run is one write: its files in one folder for each day, and its zones. Zones are written last, and a run without them does
not count, so a reader never sees half a run and a run that failed can be written again under its number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ZonedLog:
    path: str
    ts: str

    def write(self, rows: DataFrame, run: int, files: int | None = None) -> None:
        """Write one run. Files hold consecutive times; ``files`` is their number before days cut them."""
        spark, folder = rows.sparkSession, f"{self.path}/data/run={run}"
        cut = rows.repartitionByRange(files, self.ts) if files else rows.repartitionByRange(self.ts)
        cut.withColumn("day", F.to_date(self.ts)).sortWithinPartitions(self.ts).write.mode("overwrite").partitionBy("day").parquet(folder)
        written = spark.read.parquet(folder).groupBy(F.col("_metadata.file_path").alias("file"), "day")
        zones = written.agg(F.min(self.ts).alias("oldest"), F.max(self.ts).alias("newest"), F.count(F.lit(1)).alias("n"))
        zones.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/zones/run={run}")

    def zones(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/zones")

    def files(self, spark: SparkSession, start: Column, end: Column) -> list[str]:
        """The files that can hold rows from ``start`` to before ``end``. Like any listing of files, it is the driver's."""
        days = F.col("day").between(F.to_date(start), F.to_date(end))
        met = self.zones(spark).where(days & (F.col("newest") >= start) & (F.col("oldest") < end))
        return sorted(r.file for r in met.select("file").collect())

    def between(self, spark: SparkSession, start: Column, end: Column) -> DataFrame:
        """The rows from ``start`` to before ``end``."""
        files = self.files(spark, start, end)
        if not files:
            return spark.read.parquet(f"{self.path}/data").drop("run", "day").limit(0)
        rows = spark.read.parquet(*files)
        return rows.where((F.col(self.ts) >= start) & (F.col(self.ts) < end))


def merged(logs: Sequence[ZonedLog], spark: SparkSession, start: Column, end: Column, order: Sequence[str]) -> DataFrame:
    """The rows of several logs in one order, by range, from the files that the range meets."""
    rows = None
    for log in logs:
        part = log.between(spark, start, end)
        rows = part if rows is None else rows.unionByName(part)
    return rows.orderBy(*order)
