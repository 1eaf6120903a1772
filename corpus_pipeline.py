"""The corpus pipeline: toxic documents go, repeated lines go, one of each group of near duplicates stays, leaked benchmark items go,
and what is left is mixed to the target weights of its sources.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of ``docs``; the last gives
a row for each time that a document is read, with its place in training.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirflow.llm import lines, mixing, neardup, templates, toxicity
from weirflow.llm.logistic import fold
from weirflow.llm.queries import table
from weirflow.llm.texts import key_of
from weirflow.session import scratch_path

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below a half. Labels of the last fold are never learned from."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return toxicity.score(docs, model).where(F.col("score") < 0.5).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document with a larger doc_id keeps. Null texts stay null."""
    found = lines.drop_repeated_lines(docs)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept")).alias("text")
    return found.select(*[text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest doc_id. Rows without words are classes of their own."""
    kept = neardup.near_duplicates(docs).where("keeps").select(F.col("k").alias("_k"), F.col("th").alias("_th")).distinct()
    k, th = key_of(docs, "doc_id", "text")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    own = F.when(~worded, F.monotonically_increasing_id()).alias("_own")
    keyed = docs.select(F.struct("*").alias("row"), k.alias("_k"), th.alias("_th"), own)
    return keyed.join(kept, ["_k", "_th"], "left_semi").dropDuplicates(["_k", "_th", "_own"]).select("row.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of the benchmark."""
    found = templates.leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("k").alias("_k"), F.col("th").alias("_th")).distinct()
    k, th = key_of(docs, "doc_id", "text")
    keyed = docs.select(F.struct("*").alias("row"), k.alias("_k"), th.alias("_th"))
    return keyed.join(found, ["_k", "_th"], "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix reads a document, with ``copy`` (from 0) and ``position``, sorted by position."""
    path = scratch_path(spark, "mixed")
    mixing.mix(docs).select("k", "th", "positions").write.parquet(path)
    mixed = spark.read.parquet(path).groupBy(F.col("k").alias("_k"), F.col("th").alias("_th")).agg(F.collect_list("positions").alias("each"))
    k, th = key_of(docs, "doc_id", "text")
    same = F.row_number().over(Window.partitionBy("_k", "_th").orderBy(F.lit(0))).alias("_n")
    keyed = docs.select(F.struct("*").alias("row"), k.alias("_k"), th.alias("_th")).select("*", same)
    # rows of one key are equal but for other columns, and take the places of the key in turn; all meet on the key alone, so
    # the texts are dealt once before they are sorted
    placed = keyed.join(mixed, ["_k", "_th"]).select("row", F.posexplode(F.get("each", F.col("_n") - 1)).alias("copy", "position"))
    return placed.select("row.*", "copy", "position").orderBy("position", "row.doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
