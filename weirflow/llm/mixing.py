"""Mixing sources to target weights that change over the course of training.

Each source has a schedule of weights over training time from 0 to 1, linear between its knots. Its integral gives the words
the source owes by any time; the words before a document in its source are its demand, and the time at which the schedule has
asked for that many words is the document's training position. Documents are then range-sorted by position.

Only built-in functions are used. A source may hold any share of the rows: its documents are dealt by a hash into about
the square root of the number of rows buckets, which are summed before they meet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.texts import key_of
from weirflow.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order of their names, and how the weight of each changes over training, around a mean of 1.
WEIGHTS = (5.0, 2.0, 1.0)
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(rows: DataFrame, order: list[Column], rank: str, label: str) -> DataFrame:
    """Number the rows from 0 in order, range by range, so that no task sees them all. The rows are written once."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    written = spark.read.parquet(path)
    sizes = written.groupBy("_range").agg(F.count("*").alias("n"))
    before = sizes.select("_range", (F.sum("n").over(Window.orderBy("_range")) - F.col("n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return written.join(before, "_range").withColumn(rank, within - 1 + F.col("_before")).drop("_range", "_before")


def targets(sources: DataFrame, total: float, cap: float, label: str = "mix-sources") -> DataFrame:
    """Add ``target``: shares of ``total`` by ``weight``, none above ``cap`` times ``source_size``.

    What a source cannot take is shared among the others by weight, again and again until none is above: a target is
    the smaller of its cap and weight x level, and the level rises from round to round until no further source is full.
    """
    level, seen = 0.0, -1
    full = F.col("source_size") * cap
    while True:
        held = full <= F.col("weight") * level
        row = sources.agg(
            F.sum(F.when(held, full)).alias("given"),
            F.sum(F.when(~held, F.col("weight"))).alias("open"),
            F.count(F.when(held, 1)).alias("n"),
        ).first()
        if row.n == seen or not row.open:
            break
        seen, level = row.n, (total - (row.given or 0.0)) / row.open
    return sources.withColumn("target", F.least(full, F.col("weight") * level).cast("double"))


def segments(schedule: tuple[tuple[float, float], ...]) -> list[tuple[float, float, float, float, float, float]]:
    """(t0, t1, w0, w1, c0, c1) between knots: times, weights, and the share of the schedule's integral done at each end."""
    if len(schedule) < 2 or any(a[0] >= b[0] for a, b in zip(schedule, schedule[1:])) or min(w for _, w in schedule) < 0:
        raise ValueError("a schedule needs two knots or more, rising times and weights of at least 0")
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:])]
    if sum(areas) <= 0:
        raise ValueError("a schedule needs some weight")
    done = [sum(areas[:i]) / sum(areas) for i in range(len(areas) + 1)]
    return [(a[0], b[0], a[1] / sum(areas), b[1] / sum(areas), c, d) for a, b, c, d in zip(schedule, schedule[1:], done, done[1:])]


def time_of(share: Column, schedule: tuple[tuple[float, float], ...]) -> Column:
    """The time at which a schedule has asked for this share of all it asks for."""
    time = F.lit(None).cast("double")
    for t0, t1, w0, w1, c0, c1 in reversed(segments(schedule)):
        rest = F.greatest(share - c0, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + rest * (2 * (w1 - w0) / (t1 - t0)), F.lit(0.0)))
        here = F.lit(t0) + F.when(rest == 0, 0.0).otherwise(rest * 2 / (root + w0))
        time = F.when(share <= c1, here).otherwise(F.coalesce(time, F.lit(schedule[-1][0])))
    return time


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    schedules: tuple = SCHEDULES,
    share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """Per row of ``docs``: k and th (the row's key), doc_id, size, source_size, target, taken, copies, position and positions.

    ``size`` is the number of words. The sources in order of their names (code points, null last) get ``weights`` and
    ``schedules`` in turn, and share ``share`` of all words; see ``targets`` for the cap. A source's documents stand in the
    order of a hash of their doc_id, once for each time the source is read. A copy is taken if half of it or more lies
    before the target; ``taken`` counts the words of the ``copies`` taken, at most ``cap`` (rounded up) of each document, and
    ``positions`` are the training times of the first words of the copies, and ``position`` is the first (null if none is taken). Rows
    come sorted by position.

    Null and empty texts have size 0; they are taken once if their place lies before the target, with no words. Null sources are one source.
    Rows of one doc_id are rows of their own and stand side by side; equal rows take equal or neighbouring places. An empty
    table gives no rows. Other columns are left out. Reruns agree, however the rows are split.
    """
    spark = docs.sparkSession
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    slim = docs.select(
        *key_of(docs, doc_id, text),
        F.col(doc_id).cast("long").alias("doc_id"),
        word_count(F.col(text)).alias("size"),
        F.col(source).cast("string").alias("source"),
        digest.alias("h"),
    )
    path = scratch_path(spark, "mix-sizes")
    slim.write.parquet(path)
    slim = spark.read.parquet(path)
    rows, words = slim.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = max(1, math.isqrt(rows))
    bucket = F.pmod(F.conv(F.substring("h", 1, 8), 16, 10).cast("long"), F.lit(2**32)) * buckets / 2**32
    slim = slim.withColumn("bucket", F.floor(bucket).cast("long")).withColumn("none", F.col("source").isNull())
    slim = slim.withColumn("source", F.coalesce("source", F.lit("")))
    key = ["none", "source"]
    folded = slim.groupBy(*key, "bucket").agg(F.sum("size").alias("words"))
    sources = folded.groupBy(*key).agg(F.sum("words").alias("source_size"))
    path = scratch_path(spark, "mix-weights")
    turn = F.col("rank") % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    numbered = ranked(sources, [F.col("none"), F.col("source")], "rank", "mix-ranks")
    numbered.withColumn("turn", turn).withColumn("weight", weight).write.parquet(path)
    sources = targets(spark.read.parquet(path), words * share, cap)
    in_order = Window.partitionBy(*key).orderBy("bucket")
    offsets = folded.withColumn("before", F.sum("words").over(in_order) - F.col("words")).drop("words")
    offsets = offsets.join(sources.drop("rank", "weight"), key)
    placed = slim.join(offsets, [*key, "bucket"])
    in_bucket = Window.partitionBy(*key, "bucket").orderBy("h", "doc_id", "size")
    start = (F.col("before") + F.sum("size").over(in_bucket) - F.col("size")).cast("double")
    placed = placed.withColumn("start", start)
    copies = F.lit(0)
    for reading in range(math.ceil(cap)):
        middle = F.col("start") + F.col("source_size") * float(reading) + F.col("size") / 2
        copies = copies + F.when(middle < F.col("target"), 1).otherwise(0)
    placed = placed.withColumn("copies", copies.cast("long"))
    times = []
    for reading in range(math.ceil(cap)):
        share = (F.col("start") + F.col("source_size") * float(reading)) / F.col("target")
        share = F.when(F.col("target") > 0, F.least(share, F.lit(1.0))).otherwise(0.0)
        time = F.lit(None).cast("double")
        for i, schedule in enumerate(schedules):
            time = F.when(F.col("turn") % len(schedules) == i, time_of(share, schedule)).otherwise(time)
        times.append(time)
    placed = placed.withColumn("positions", F.slice(F.array(*times), F.lit(1), F.col("copies").cast("int")))
    return placed.select(
        "k",
        "th",
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
        F.get("positions", F.lit(0)).alias("position"),
        "positions",
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")
