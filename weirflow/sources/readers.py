"""Readers and parsers for text inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions.scalars import lenient_bool, parts, whole
from weirflow.operators.ordered import row_index
from weirflow.sources.schemas import TAG_USE_FIELDS, USER_FIELDS


def text_lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """One row per line. ``path`` may be a glob over many folders."""
    return spark.read.option("recursiveFileLookup", str(recursive).lower()).text(path)


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file and their line number from 1.

    Spark reads a file in splits and keeps the line order inside a split, so (split offset, running id)
    orders the lines of a file. The splits are the blocks of the numbering: lines are counted per split
    and each split gets its opening number. The columns ``split_at`` and ``line_id`` keep the order.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_at"),
        F.monotonically_increasing_id().alias("line_id"),
        "value",
    )
    return row_index(lines, ["split_at", "line_id"], ["file"], "line_no", block=F.col("split_at"))


def numbered_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines numbered from 1 along all files, in the order of the files' names; the splits are the blocks of the numbering."""
    lines = spark.read.text(path).select(
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")).alias("split"),
        F.monotonically_increasing_id().alias("line_id"),
        "value",
    )
    return row_index(lines, ["split", "line_id"], [], "line_no", block=F.col("split"))


def parse_links(lines: DataFrame) -> DataFrame:
    """``src: d1 d2 …`` to one row per link; a line without targets gives none."""
    halves = F.split(F.col("value"), ":", 2)
    targets = lines.select(
        F.trim(F.get(halves, F.lit(0))).cast("long").alias("src"),
        F.explode(parts(F.get(halves, F.lit(1)), r"\s+")).alias("dst"),
    )
    return targets.select("src", F.col("dst").cast("long").alias("dst"))


def titles(lines: DataFrame) -> DataFrame:
    """Numbered lines as ``(id, title)``."""
    return lines.select(F.col("line_no").alias("id"), F.col("value").alias("title"))


def _typed(text: Column, type_name: str) -> Column:
    if type_name == "boolean":
        return lenient_bool(text)
    if type_name == "long":
        return whole(text)
    return text.try_cast(type_name)


def parse_pairs(lines: DataFrame, fields: Sequence[tuple[str, str]], key: str = "screen_name") -> DataFrame:
    """``(key,v0 v1 …)`` to typed columns by position. Missing values are null (false for booleans)."""
    inner = F.regexp_extract("value", r"^\((.*)\)$", 1)
    name = F.substring_index(inner, ",", 1)
    rest = F.split(F.substr(inner, F.length(name) + 2), " ")
    return (
        lines.where(F.col("value").rlike(r"^\(.*\)$"))
        .select(name.alias(key), rest.alias("__rest"))
        .select(key, *[_typed(F.get("__rest", F.lit(i)), t).alias(n) for i, (n, t) in enumerate(fields)])
    )


def parse_tag_uses(lines: DataFrame) -> DataFrame:
    return parse_pairs(lines, TAG_USE_FIELDS)


def parse_users(lines: DataFrame) -> DataFrame:
    return parse_pairs(lines, USER_FIELDS)


def parse_relations(lines: DataFrame) -> DataFrame:
    """``(user,follower)`` pairs."""
    return parse_pairs(lines, [("follower", "string")])


def packed_records(lines: DataFrame, record_sep: str = ":", field_sep: str = ",") -> DataFrame:
    """Wire lines to records: each non-empty part of a line, as a list of fields. Works on streams."""
    record = lines.where(F.length("value") > 0).select(F.explode(parts("value", record_sep)).alias("record"))
    return record.select(F.split("record", field_sep).alias("fields"))


def wire_tag_uses(lines: DataFrame) -> DataFrame:
    """``user,tag,ts,quote,…,level,`` lines to typed rows."""
    fields = F.split("value", ",")
    return (
        lines.where(F.length("value") > 0)
        .select(fields.alias("f"))
        .select(
            F.get("f", F.lit(0)).alias("screen_name"),
            *[_typed(F.get("f", F.lit(i + 1)), t).alias(n) for i, (n, t) in enumerate(TAG_USE_FIELDS)],
        )
    )


def wire_users(lines: DataFrame) -> DataFrame:
    records = packed_records(lines)
    return records.select(
        F.get("fields", F.lit(0)).alias("screen_name"),
        *[_typed(F.get("fields", F.lit(i + 1)), t).alias(n) for i, (n, t) in enumerate(USER_FIELDS)],
    )


def wire_relations(lines: DataFrame) -> DataFrame:
    return packed_records(lines).select(
        F.get("fields", F.lit(0)).alias("screen_name"), F.get("fields", F.lit(1)).alias("follower")
    )


def decode_topic_payload(messages: DataFrame, topic: str = "topic", payload: str = "payload") -> DataFrame:
    """``users/{user}/{location}/{device}`` with payload ``{temperature}/{humidity}`` to columns."""
    place, reading = F.split(topic, "/"), F.split(F.col(payload).cast("string"), "/")
    return messages.select(
        F.get(place, F.lit(1)).alias("user"),
        F.get(place, F.lit(3)).alias("device"),
        F.get(place, F.lit(2)).alias("location"),
        F.get(reading, F.lit(0)).cast("double").alias("temperature"),
        F.get(reading, F.lit(1)).cast("double").alias("humidity"),
    )


def permissive_json(lines: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """Parsed rows and the lines that did not parse. No line raises an error and none gets lost."""
    parsed = lines.withColumn(
        "__r", F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE"})
    )
    bad = F.col("__r").isNull() | F.col("__r._corrupt_record").isNotNull()
    good = parsed.where(~bad).select("__r.*").drop("_corrupt_record")
    return good, parsed.where(bad).select("value")


def libsvm(spark: SparkSession, path: str, features: int | None = None) -> DataFrame:
    reader = spark.read.format("libsvm")
    if features is not None:
        reader = reader.option("numFeatures", str(features))
    return reader.load(path)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    driver: str | None = None,
    partition_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
) -> DataFrame:
    """A database table; with ``partition_on`` and ``bounds`` it is read by several tasks."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if driver:
        reader = reader.option("driver", driver)
    if partition_on:
        low, high = bounds
        reader = (
            reader.option("partitionColumn", partition_on)
            .option("lowerBound", str(low))
            .option("upperBound", str(high))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def random_integers(spark: SparkSession, n: int, seed: int, high: int = 1000) -> DataFrame:
    """``n`` rows of value, event time and message id, the same for the same seed."""
    return spark.range(n).select(
        F.floor(F.rand(seed) * high).cast("int").alias("value"),
        F.timestamp_millis(F.col("id") * 100).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("msgid"),
    )


def random_choices(spark: SparkSession, n: int, seed: int, choices: Sequence[str], name: str = "sentence") -> DataFrame:
    """``n`` rows, each one of the given texts."""
    array = F.array(*[F.lit(c) for c in choices])
    index = F.floor(F.rand(seed) * len(choices)).cast("int")
    return spark.range(n).select(F.col("id").alias("seq"), F.get(array, index).alias(name))


def cyclic_batches(spark: SparkSession, rows: Sequence[tuple], schema: str, cycles: int) -> DataFrame:
    """The same small list of rows ``cycles`` times, with the number of the cycle."""
    once = spark.createDataFrame(list(rows), schema)
    repeat = F.sequence(F.lit(0).cast("long"), F.lit(cycles - 1).cast("long"))
    return once.withColumn("cycle", F.explode(repeat))
