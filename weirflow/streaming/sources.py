"""Streaming sources, built from options so that the transport is a matter of configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def line_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files that appear in a folder."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def table_stream(
    spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_trigger: int | None = None, bytes_per_trigger: int | None = None
) -> DataFrame:
    """Rows of the Parquet files that appear in a folder. ``files_per_trigger`` or ``bytes_per_trigger`` bounds a batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(folder)


def without_suffix(suffix: str) -> str:
    """A glob of the names that don't end in ``suffix``: one alternative for each place where a name first differs from it.

    Seen from its end, a name keeps some of the suffix and then has another character, or is no longer than that.
    """
    ends = [suffix[i:] for i in range(1, len(suffix) + 1)]
    return "{" + ",".join([f"*[!{suffix[i]}]{end}" for i, end in enumerate(ends)] + [end for end in ends if end]) + "}"


def dropped_files(
    spark: SparkSession,
    path: str,
    archive: str | None = None,
    ignore_suffix: str = ".ignore",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Lines of files dropped into a folder. Files with the ignored suffix are left, finished files are
    moved to the archive. A writer must move a file in when it is complete.
    """
    reader = spark.readStream.option("pathGlobFilter", without_suffix(ignore_suffix))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    return lines.where(~F.col("file").endswith(ignore_suffix)).select("value")


def kafka_options(
    servers: str,
    topic: str | None = None,
    pattern: str | None = None,
    start: str = "latest",
    start_ms: int | None = None,
    per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka source: a topic or a pattern of topics, and where to start."""
    if (topic is None) == (pattern is None):
        raise ValueError("give a topic or a pattern of topics")
    options = {"kafka.bootstrap.servers": servers}
    options |= {"subscribe": topic} if topic else {"subscribePattern": pattern}
    if start_ms is not None:
        options["startingTimestamp"] = str(start_ms)
    elif start in ("earliest", "latest"):
        options["startingOffsets"] = start
    else:
        raise ValueError("the start must be 'earliest', 'latest' or a time")
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(**options)).load()


def decode_messages(messages: DataFrame, schema: str | None = None, metadata: bool = False) -> DataFrame:
    """Message values as text, or as typed columns for JSON; with their place in the topic if wanted."""
    value = F.col("value").cast("string")
    place = ["topic", "partition", "offset"] if metadata else []
    if schema is None:
        return messages.select(value.alias("value"), *place)
    return messages.select(F.from_json(value, schema).alias("v"), *place).select("v.*", *place)


def rate_numbers(spark: SparkSession, rows_per_batch: int, partitions: int = 1) -> DataFrame:
    """Numbered rows, the same number in every batch."""
    return (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("numPartitions", partitions)
        .load()
    )
