"""Streaming jobs: a source, a per-batch step and a table. All of them stop when the input is used up."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirflow.operators.ordered import Fold, prefix
from weirflow.streaming.tables import BatchTable


def drain(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``step`` on every micro-batch of what is there now, and return the finished query when all is done."""
    query = (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def batch_sizes(query: StreamingQuery) -> list[tuple[int, int, int]]:
    """(batch, rows, milliseconds) of a query's batches that had rows, as Spark recorded them.

    Spark keeps as many as ``spark.sql.streaming.numRecentProgressUpdates``; fewer than there were is an error.
    """
    records = query.recentProgress
    if records and records[0]["batchId"] > 0 and len(records) >= 100:
        raise ValueError("the first batches are no longer on record")
    return [(r["batchId"], r["numInputRows"], r["batchDuration"]) for r in records if r["numInputRows"]]


def run_until_empty(frame: DataFrame, path: str, checkpoint: str, mode: str = "append", by: Sequence[str] = ()) -> None:
    """Write an append-mode result to Parquet files, one folder for each value of ``by``; the file sink records each batch once."""
    query = (
        frame.writeStream.format("parquet")
        .partitionBy(*by)
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


COMPACT_EVERY = 50


def _compact(table: BatchTable, batch: DataFrame, batch_id: int, every: int | None = None) -> None:
    """Now and then merge the batches before this one. This one may still be repeated, so it stays apart."""
    if batch_id and batch_id % (every or COMPACT_EVERY) == 0:
        table.compact(batch.sparkSession, batch_id - 1)


def keep_table(
    stream: DataFrame,
    table: BatchTable,
    contribution: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    compact_every: int = COMPACT_EVERY,
) -> None:
    """Add each batch's contribution to the table; merge the folders every ``compact_every`` batches."""

    def step(batch: DataFrame, batch_id: int) -> None:
        table.write(contribution(batch), batch_id)
        _compact(table, batch, batch_id, compact_every)

    drain(stream, step, checkpoint)


def snapshot_per_batch(stream: DataFrame, path: str, checkpoint: str) -> None:
    """A new folder for every batch. A repeated batch replaces its folder."""
    drain(
        stream,
        lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"),
        checkpoint,
    )


def running_values(
    stream: DataFrame,
    table: BatchTable,
    out: str,
    value: str,
    order: Sequence[str],
    keys: Sequence[str],
    checkpoint: str,
    block: Column | None = None,
) -> None:
    """Running count and sum per key over the whole stream, one output row per input row.

    ``table`` (keys, n, total) holds what every batch brought for each key. A batch opens with the sum of
    the batches before it, so a restarted or repeated batch opens with the same values.
    """
    on = list(keys)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        brought = batch.groupBy(*on).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        table.write(brought, batch_id)
        opening = table.read(spark, batch_id, batch.select(*on)).select(*on, F.col("n").alias("n0"), F.col("total").alias("t0"))
        folds = {"n": Fold("sum", F.lit(1).cast("long")), "total": Fold("sum", F.col(value))}
        rows = prefix(batch, order, folds, on, block)
        joined = rows.join(opening, on, "left").withColumns(
            {
                "n": F.col("n") + F.coalesce("n0", F.lit(0)),
                "total": F.col("total") + F.coalesce("t0", F.lit(0)),
            }
        )
        joined.drop("n0", "t0").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        _compact(table, batch, batch_id)

    drain(stream, step, checkpoint)


def count_windows(
    stream: DataFrame, table: BatchTable, out: str, size: int, value: str, order: Sequence[str], keys, checkpoint: str
) -> None:
    """Tumbling windows of ``size`` rows per key. ``out`` receives window parts (keys, window_no, cnt, total);
    ``complete_windows`` puts them together. A window that spans batches has a part in each.
    """
    on = list(keys)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table.write(batch.groupBy(*on).agg(F.count(F.lit(1)).alias("n")), batch_id)
        opening = table.read(spark, batch_id, batch.select(*on)).select(*on, F.col("n").alias("n0"))
        rows = prefix(batch, order, {"__n": Fold("sum", F.lit(1).cast("long"))}, on).join(opening, on, "left")
        at = F.col("__n") + F.coalesce("n0", F.lit(0))
        parts = (
            rows.withColumn("__at", at)
            .withColumn("window_no", F.expr(f"(__at - 1) div {size}"))
            .groupBy(*on, "window_no")
            .agg(F.count(F.lit(1)).alias("cnt"), F.sum(value).alias("total"))
        )
        parts.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        _compact(table, batch, batch_id)

    drain(stream, step, checkpoint)


def sliding_count_windows(
    stream: DataFrame, table: BatchTable, out: str, size: int, slide: int, value: str, order: Sequence[str], keys, checkpoint: str
) -> None:
    """Windows of the last ``size`` rows per key, one every ``slide`` rows (``slide`` must divide ``size``).

    ``out`` receives the parts of panes of ``slide`` rows, as ``count_windows`` does; ``complete_sliding_windows`` adds up the
    panes of each window.
    """
    if size % slide:
        raise ValueError("the slide must divide the size")
    count_windows(stream, table, out, slide, value, order, keys, checkpoint)


def complete_sliding_windows(parts: DataFrame, size: int, slide: int, keys: Sequence[str]) -> DataFrame:
    """(keys, window_no, cnt, total): the windows that are full; window 0 ends after the first ``size`` rows."""
    panes = complete_windows(parts, slide, keys)
    held = size // slide
    ends = panes.withColumn("window_no", F.explode(F.sequence(F.col("window_no") - (held - 1), F.col("window_no"))))
    whole = ends.where("window_no >= 0").groupBy(*keys, "window_no").agg(F.sum("cnt").alias("cnt"), F.sum("total").alias("total"))
    return whole.where(F.col("cnt") == size)


def join_sides(stream: DataFrame, table: BatchTable, out: str, on: str, side: str, sides: Sequence[str], value: str, checkpoint: str) -> None:
    """Join any number of sources on a key that each of them has once.

    ``stream`` is the sources' union, with the name of the source in ``side``; ``table`` (on, side, value) keeps what has come. A
    key is written with one column for each source by the batch that completes it. A second row of a source for a key is an error.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table.write(batch.select(on, side, value), batch_id)
        rows = table.read(spark, batch_id + 1, batch.select(on))
        again = rows.groupBy(on, side).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
        if again:
            raise ValueError(f"a second row of {again[0][side]} for {on} {again[0][on]}")
        columns = [F.max(F.when(F.col(side) == s, F.col(value))).alias(s) for s in sides]
        whole = rows.groupBy(on).agg(F.count(F.lit(1)).alias("n"), *columns).where(F.col("n") == len(sides))
        whole.drop("n").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    drain(stream, step, checkpoint)


def kept_histogram(stream: DataFrame, counts: BatchTable, histogram: BatchTable, key: str, width: int, checkpoint: str) -> None:
    """Counts per key, and beside them how many keys lie in each bucket of counts, kept up to date.

    A key whose count changes leaves its old bucket (-1) and enters the new one (+1), so a batch touches its own keys only.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        brought = batch.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        counts.write(brought, batch_id)
        before = counts.read(spark, batch_id, batch.select(key)).select(key, F.col("n").alias("n0"))
        moved = brought.join(before, key, "left")
        old = F.struct(F.expr(f"n0 div {width}").alias("bucket"), F.lit(-1).cast("long").alias("n_keys"))
        new = F.struct(F.expr(f"(coalesce(n0, 0L) + n) div {width}").alias("bucket"), F.lit(1).cast("long").alias("n_keys"))
        steps = moved.select(F.explode(F.array(old, new)).alias("s")).select("s.*").where("bucket IS NOT NULL")
        histogram.write(steps.groupBy("bucket").agg(F.sum("n_keys").alias("n_keys")), batch_id)

    drain(stream, step, checkpoint)


def complete_windows(parts: DataFrame, size: int, keys: Sequence[str]) -> DataFrame:
    whole = parts.groupBy(*keys, "window_no").agg(F.sum("cnt").alias("cnt"), F.sum("total").alias("total"))
    return whole.where(F.col("cnt") == size)


def lossy_step(table: BatchTable, key: str, width: int) -> Callable[[DataFrame, int], None]:
    """Heavy hitters over a stream: lossy counting with the batch as the unit of pruning.

    Rows of a batch are counted per key before anything is shuffled, so a hot key costs one row per task.
    The state (key, f, delta, seen) is rewritten from the state of the batch before; ``seen`` is the number
    of rows so far. A key enters with delta = completed buckets, and is dropped when f + delta does not
    exceed the completed buckets, which is the rule for rows applied once per batch.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = latest_state(table, spark, batch_id)
        counts = batch.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
        before = old.agg(F.coalesce(F.max("seen"), F.lit(0)).alias("seen"))
        arrived = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c"))
        seen = before.scalar() + arrived.scalar()
        finished = F.floor(before.scalar() / width).cast("long")
        joined = old.where(F.col(key).isNotNull()).select(key, "f", "delta").join(counts, key, "full")
        state = joined.select(
            key,
            (F.coalesce("f", F.lit(0)) + F.coalesce("c", F.lit(0))).alias("f"),
            F.coalesce("delta", finished).alias("delta"),
            seen.alias("seen"),
        ).where(F.col("f") + F.col("delta") > F.floor(F.col("seen") / width))
        # a row without a key carries the number of rows when every key has been dropped
        marker = arrived.select(
            F.lit(None).cast(batch.schema[key].dataType).alias(key),
            F.lit(0).cast("long").alias("f"),
            F.lit(0).cast("long").alias("delta"),
            (before.scalar() + F.col("c")).alias("seen"),
        )
        table.write(state.unionByName(marker), batch_id)
        table.forget(spark, batch_id - 1)

    return step


def latest_state(table: BatchTable, spark, before: int | None = None) -> DataFrame:
    """The state a table of whole states holds after its last batch (before ``before``)."""
    done = [b for b in table.batches(spark) if before is None or b < before]
    if not done:
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(f"{table.path}/batch={done[-1]}")


def lossy_result(table: BatchTable, spark, key: str) -> DataFrame:
    return latest_state(table, spark).where(F.col(key).isNotNull()).select(
        key, "f", "delta", (F.col("f") + F.col("delta")).alias("estimate")
    )


def without_blocked(
    stream: DataFrame, blocked: Callable[[], DataFrame], on: str, out: str, checkpoint: str
) -> None:
    """Drop rows whose key is on a block list. ``blocked`` is called for every batch, so a changed list
    takes effect with the next batch.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        kept = batch.join(blocked(), on, "left_anti")
        kept.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    drain(stream, step, checkpoint)


def late_split(batch: DataFrame, ts: str, watermark: Column) -> tuple[DataFrame, DataFrame]:
    """The rows of a batch in time, and those older than the watermark of the batches before."""
    late = F.col(ts) < watermark
    late = F.coalesce(late, F.lit(False))
    return batch.where(~late), batch.where(late)


def divert_late(stream: DataFrame, table: BatchTable, out: str, late_out: str, ts: str, lag: str, checkpoint: str) -> None:
    """Write rows in time to ``out`` and late rows to ``late_out``.

    A row is late when it lies more than ``lag`` behind the newest time of the batches before. ``table``
    (newest) keeps the newest time of every batch.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table.write(batch.agg(F.max(ts).alias("newest")), batch_id)
        mark = table.read(spark, before=batch_id).select((F.col("newest") - F.expr(f"interval {lag}")).alias("mark"))
        on_time, late = late_split(batch, ts, mark.scalar())
        on_time.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        late.write.mode("overwrite").parquet(f"{late_out}/batch_id={batch_id}")
        _compact(table, batch, batch_id)

    drain(stream, step, checkpoint)


def newest_time(df: DataFrame) -> DataFrame:
    """Merge rule for the table of ``divert_late``."""
    return df.agg(F.max("newest").alias("newest"))


# --- operators with Spark's own streaming state -------------------------------------------


def _watermarked(stream: DataFrame, ts: str, lag: str) -> DataFrame:
    """A watermark needs a time with a zone."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lag)


def windowed_counts(stream: DataFrame, ts: str, length: str, slide: str, lag: str, keys: Sequence[str]) -> DataFrame:
    """Counts per event-time window with a watermark. Appended when the watermark passes the window."""
    window = F.window(ts, length, slide)
    start, end = (F.col(f"w.{side}").cast("timestamp_ntz").alias(f"window_{side}") for side in ("start", "end"))
    return (
        _watermarked(stream, ts, lag)
        .groupBy(window.alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(start, end, *keys, "cnt")
    )


def union_windows(streams: Mapping[str, DataFrame], ts: str, length: str, lag: str) -> DataFrame:
    """Counts per event-time window of several sources in one stream, with the source's name.

    Every source has a watermark of its own. A window is appended when the slowest has passed it, so that a source which lags
    behind loses no row to the others; this is Spark's policy ``min`` for several watermarks.
    """
    if streams and next(iter(streams.values())).sparkSession.conf.get("spark.sql.streaming.multipleWatermarkPolicy") != "min":
        raise ValueError("the watermark of several sources must be that of the slowest")
    both = None
    for name, stream in streams.items():
        one = _watermarked(stream.select(ts), ts, lag).withColumn("source", F.lit(name))
        both = one if both is None else both.unionByName(one)
    window = F.window(ts, length).alias("w")
    counted = both.groupBy(window, "source").agg(F.count(F.lit(1)).alias("cnt"))
    return counted.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "source", "cnt")


def salted_counts(stream: DataFrame, ts: str, length: str, lag: str, key: str, salt_on: str, salts: int = 8) -> DataFrame:
    """As ``windowed_counts``, with a hot key counted in several parts of the state; add up the rows per
    window and key when reading.
    """
    salted = stream.withColumn("salt", F.pmod(F.xxhash64(salt_on), F.lit(salts)))
    return windowed_counts(salted, ts, length, length, lag, [key, "salt"])


def once_per_id(stream: DataFrame, ts: str, ident: str, lag: str) -> DataFrame:
    """Drop repeats of a message id that come within the lag."""
    return _watermarked(stream, ts, lag).dropDuplicatesWithinWatermark([ident])


def join_streams(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str, timeout: str) -> DataFrame:
    """Inner join of two streams on a key. A row waits for its partner at most ``timeout``, then it expires."""
    a = _watermarked(left, left_ts, timeout)
    b = _watermarked(right, right_ts, timeout).withColumnRenamed(on, f"__{on}")
    near = F.expr(
        f"{on} = __{on} AND {right_ts} BETWEEN {left_ts} - interval {timeout} AND {left_ts} + interval {timeout}"
    )
    return a.join(b, near).drop(f"__{on}")


def tick(stream_writer, seconds: int):
    """Emit every ``seconds`` seconds."""
    if seconds < 1:
        raise ValueError("the frequency must be at least 1 second")
    return stream_writer.trigger(processingTime=f"{seconds} seconds")
