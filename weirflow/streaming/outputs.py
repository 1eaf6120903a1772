"""Streaming outputs that hold each batch once: segments that are replaced, files of a bounded size, several named streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.operators.ordered import Fold, prefix
from weirflow.streaming.jobs import drain, late_split
from weirflow.streaming.tables import BatchTable


def rollup_late(
    stream: DataFrame, path: str, late_out: str, newest: BatchTable, ts: str, dims: Sequence[str], value: str, lag: str, checkpoint: str
) -> None:
    """Hourly rollups (segment, dims, cnt, total) in one folder for each hour, taking late rows for ``lag``.

    A batch replaces the whole segment of every hour it touches. A segment holds what all batches before have brought, folded,
    and beside it what the last batch has brought, so that a repeated batch replaces its own part. Rows more than ``lag``
    behind the newest time of the batches before are written to ``late_out``.
    """
    keys = ["segment", *dims]

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest.write(batch.agg(F.max(ts).alias("newest")), batch_id)
        mark = newest.read(spark, before=batch_id).select((F.col("newest") - F.expr(f"interval {lag}")).alias("mark"))
        on_time, late = late_split(batch, ts, mark.scalar())
        late.write.mode("overwrite").parquet(f"{late_out}/batch_id={batch_id}")
        hour = F.date_format(ts, "yyyy-MM-dd-HH").alias("segment")
        brought = on_time.groupBy(hour, *dims).agg(F.count(F.lit(1)).alias("cnt"), F.sum(value).alias("total"))
        brought = brought.withColumn("batch_id", F.lit(batch_id).cast("long"))
        # one folder for each hour that the batch touches, and no other, is read and replaced
        touched = [r.segment for r in brought.select("segment").distinct().collect()]
        held = [f"{path}/segment={hour}" for hour in touched if _exists(spark, f"{path}/segment={hour}")]
        if held:
            old = spark.read.schema(brought.schema).option("basePath", path).parquet(*held).where(F.col("batch_id") < batch_id)
            old = old.groupBy(*keys).agg(F.sum("cnt").alias("cnt"), F.sum("total").alias("total"))
            brought = brought.unionByName(old.withColumn("batch_id", F.lit(-1).cast("long")))
        brought = brought.hint("rebalance", "segment")
        brought.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("segment").parquet(path)

    drain(stream, step, checkpoint)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def rolled_up(rows: DataFrame, dims: Sequence[str]) -> DataFrame:
    """What the segments of ``rollup_late`` hold, with the hour as a time."""
    hour = F.to_timestamp("segment", "yyyy-MM-dd-HH").cast("timestamp_ntz").alias("hour")
    return rows.groupBy(hour, *dims).agg(F.sum("cnt").alias("cnt"), F.sum("total").alias("total"))


def rolled_files(
    stream: DataFrame,
    value: str,
    order: Sequence[str],
    folder: str,
    size: int,
    checkpoint: str,
    action: Callable[[str], None] | None = None,
) -> None:
    """Text files of at most ``size`` bytes. Finished ones are moved to ``folder``/done, then ``action`` gets the batch's folder.

    Bytes are summed up along ``order``, and a line goes to the file that its first byte falls into. A batch is written aside and
    moved as a whole; a batch that is repeated replaces what it left before. A line longer than ``size`` is an error.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = F.octet_length(value) + 1
        biggest = batch.agg(F.max(own)).first()[0]
        if biggest is None:
            return
        if biggest > size:
            raise ValueError(f"a line of {biggest} bytes is larger than a file")
        placed = prefix(batch.where(F.col(value).isNotNull()), order, {"__end": Fold("sum", own.cast("long"))})
        # a file holds lines that begin in a stretch of so many bytes, so its last line ends within size
        file = F.expr(f"(__end - octet_length({value}) - 1) div {size - biggest + 1}").alias("file")
        lines = placed.select(F.col(value).alias("value"), file, "__end").repartition("file").sortWithinPartitions("file", "__end")
        lines.drop("__end").write.mode("overwrite").partitionBy("file").text(f"{folder}/open/batch={batch_id}")
        path = spark._jvm.org.apache.hadoop.fs.Path
        files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        done = path(f"{folder}/done/batch={batch_id}")
        files.delete(done, True)
        files.mkdirs(done.getParent())
        if not files.rename(path(f"{folder}/open/batch={batch_id}"), done):
            raise OSError(f"cannot move batch {batch_id}")
        if action:
            action(done.toString())

    drain(stream, step, checkpoint)


def fan_out(stream: DataFrame, name: Column, outputs: dict[str, Callable[[DataFrame, int], None]], checkpoint: str) -> None:
    """Send each row to the output of its stream's name, from one pass over the batch; other rows go nowhere.

    Every output gets the batch's number and must replace what it holds of it, as ``batch_folder`` does: after a failure
    between two outputs all get the batch again.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn("stream", name).persist()
        try:
            for output, write in outputs.items():
                write(named.where(F.col("stream") == output).drop("stream"), batch_id)
        finally:
            named.unpersist()

    drain(stream, step, checkpoint)


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """An output of one folder for each batch."""
    return lambda rows, batch_id: rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
