"""Row shaping for external systems, and batch writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route_by_field(df: DataFrame, topic: Column, default: str | None = None) -> DataFrame:
    """Add the topic to publish each row to. Rows without a topic get the default, or go if there is none."""
    routed = df.withColumn("topic", F.coalesce(topic, F.lit(default)) if default else topic)
    return routed.where(F.col("topic").isNotNull())


def kafka_rows(df: DataFrame, key: str, value: str, topic: Column, default: str | None = None) -> DataFrame:
    """The key, value and topic columns a Kafka writer expects."""
    return route_by_field(df, topic, default).select(
        "topic", F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value")
    )


def metric_points(df: DataFrame, metric: Column, ts: str, value: str, tags: Sequence[str]) -> DataFrame:
    """Time-series points. Delivery may repeat a point, so repeats go; tags are compared name by name, null with null."""
    pairs = [F.struct(F.lit(t).alias("name"), F.col(t).cast("string").alias("value")) for t in sorted(tags)]
    shaped = df.select(
        metric.alias("metric"),
        F.col(ts).alias("ts"),
        F.col(value).cast("double").alias("value"),
        F.array_join(F.array(*[F.concat(F.lit(f"{t}="), F.col(t).cast("string")) for t in sorted(tags)]), ",").alias("tag_text"),
        F.array(*pairs).alias("tag_list"),
        F.create_map(*[c for t in sorted(tags) for c in (F.lit(t), F.col(t).cast("string"))]).alias("tags"),
    )
    return shaped.dropDuplicates(["metric", "ts", "tag_list"]).drop("tag_list")


def index_documents(
    df: DataFrame, index: str, kind: str, ident: str, fields: Sequence[str], multi: Sequence[str] = (), token: str = "|"
) -> DataFrame:
    """Documents for a search index: (index, type, id, source). Only the schema's fields are kept, and
    multi-valued fields are split at the token.
    """
    kept = [f for f in fields if f in df.columns]
    pattern = f"\\Q{token}\\E"
    values = [F.split(F.col(f), pattern).alias(f) if f in multi else F.col(f) for f in kept]
    return df.select(
        F.lit(index).alias("index"),
        F.lit(kind).alias("type"),
        F.col(ident).cast("string").alias("id"),
        F.to_json(F.struct(*values)).alias("source"),
    )


def text_tuples(df: DataFrame, columns: Sequence[str], null: str = "null") -> DataFrame:
    """Rows as text ``(a,b)``. A null keeps its place, as the text ``null``."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(null)) for c in columns]
    return df.select(F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")")).alias("value"))


def write_text(df: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists") -> None:
    text_tuples(df, columns).write.mode(mode).text(path)


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", rows_per_file: int = 1_000_000, mode: str = "append"
) -> None:
    """Delimited files; a new file is begun after ``rows_per_file`` rows."""
    df.write.mode(mode).option("sep", sep).option("maxRecordsPerFile", rows_per_file).csv(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite", rows_per_file: int = 0):
    """Parquet in one folder per value of ``by``.

    Rows are dealt by those columns, and adaptive execution cuts what a frequent value brings to tasks of its advisory size.
    """
    writer = df.hint("rebalance", *by).write.mode(mode).partitionBy(*by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def with_time_partition(df: DataFrame, ts: str, pattern: str = "yyyy/MM/dd", name: str = "part") -> DataFrame:
    return df.withColumn(name, F.date_format(ts, pattern))


def write_table(df: DataFrame, table: str, by: Sequence[str], mode: str = "append") -> None:
    """A catalog table whose partitions appear as they are needed; overwriting replaces only those written."""
    spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    if spark.catalog.tableExists(table):
        before = spark.conf.get(setting)  # no option of the writer does this for a catalog table
        spark.conf.set(setting, "dynamic")
        try:
            df.select(*spark.table(table).columns).write.mode(mode).insertInto(table)
        finally:
            spark.conf.set(setting, before)
    else:
        df.write.mode(mode).partitionBy(*by).saveAsTable(table)


def write_jdbc(df: DataFrame, url: str, table: str, driver: str | None = None, batch: int = 1000) -> None:
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch)
    if driver:
        writer = writer.option("driver", driver)
    writer.mode("append").save()


def write_key_values(df: DataFrame, path: str, key: str, value: str) -> None:
    """A Hadoop sequence file of text keys and values. The format has no DataFrame writer."""
    pairs = df.select(F.col(key).cast("string"), F.col(value).cast("string"))
    pairs.rdd.map(tuple).saveAsSequenceFile(path)


def write_model_output(predictions: DataFrame, path: str, drop: Sequence[str]) -> None:
    """CSV of predictions without vector and index columns, in one folder per tag."""
    predictions.drop(*drop).write.mode("overwrite").option("header", "true").partitionBy("hashtag").csv(path)
