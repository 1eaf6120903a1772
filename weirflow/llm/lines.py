"""Line de-duplication over levelled sorted runs of line hashes.

A run is a table of (line hash, number of documents, keeper), bucketed and sorted by the hash. A new batch of documents is
folded to one such table, merge-anti-joined with the runs, which drops lines that are settled and whose keeper the batch
cannot change, and added as a run of level 0. When a level holds ``fanout`` runs they are merged into one of the next level.
All runs share their buckets, so a batch that is dealt the same way joins them in place.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from weirflow.llm.texts import SPACES, column, key_of, pieces, shards_for
from weirflow.session import scratch_path

SHARD_BYTES = 32_000_000
LINES_SQL = "k long, th long, h1 long, h2 long, at array<int>"
HASH = ["h1", "h2"]


def _lines(min_chars: int):
    """(k, th, hash, positions) of each key of ``min_chars`` code points or more in a document."""

    def work(batches):
        for piece in pieces(batches):
            lists = pc.split_pattern(pc.fill_null(column(piece, "text").cast(pa.large_string()), ""), "\n")
            row = pc.list_parent_indices(lists).to_numpy()
            keys = pc.utf8_trim(lists.flatten(), characters=SPACES.decode())
            at = np.arange(len(row)) - np.searchsorted(row, row)
            long_enough = pc.greater_equal(pc.utf8_length(keys), min_chars)
            chosen = np.flatnonzero(long_enough.to_numpy(zero_copy_only=False))
            texts = pc.ascii_lower(keys.filter(long_enough)).cast(pa.large_binary()).to_pylist()
            if not texts:
                continue
            h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, texts)), dtype=np.int64).reshape(-1, 2)
            row, at = row[chosen], at[chosen]
            order = np.lexsort((at, h[:, 1], h[:, 0], row))
            row, at, h = row[order], at[order], h[order]
            new = np.concatenate(([True], (row[1:] != row[:-1]) | (h[1:] != h[:-1]).any(axis=1)))
            cuts = np.flatnonzero(new)
            lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(at)), pa.int32()), pa.array(at, pa.int32()))
            who = pa.array(row[cuts])
            arrays = [column(piece, "k").take(who), column(piece, "th").take(who), pa.array(h[cuts, 0]), pa.array(h[cuts, 1]), lists]
            yield pa.RecordBatch.from_arrays(arrays, names=["k", "th", "h1", "h2", "at"])

    return work


class LineRuns:
    """The runs of line hashes seen so far, by level."""

    def __init__(self, spark: SparkSession, buckets: int, min_docs: int, fanout: int = 2):
        self.spark, self.buckets, self.min_docs, self.fanout = spark, buckets, min_docs, fanout
        self.levels: list[list[DataFrame]] = []

    def _write(self, run: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = run.repartition(self.buckets, *HASH).write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
        writer.option("path", scratch_path(self.spark, "line-run")).saveAsTable(name)
        written = self.spark.table(name)
        written.schema  # resolved now, so the name can go while the files stay
        self.spark.sql(f"DROP TABLE {name}")
        return written

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (h1, h2, k), one row for each line hash of a document."""
        own = lines.groupBy(*HASH).agg(F.count("*").alias("n_docs"), F.max("k").alias("keeper"))
        for run in [r for level in self.levels for r in level]:
            settled = run.where(F.col("n_docs") >= self.min_docs).select(*[F.col(c).alias(f"{c}_") for c in (*HASH, "keeper")])
            own = own.join(settled, F.expr("h1 = h1_ AND h2 = h2_ AND keeper <= keeper_"), "left_anti")
        self._put(self._write(own), 0)

    def _put(self, run: DataFrame, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = self._write(self._merge(self.levels[level]))
            self.levels[level] = []
            self._put(merged, level + 1)

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        """The runs merged bucket by bucket. A union is no way to do it: one of bucketed tables is not dealt as it claims to be."""
        both = runs[0]
        for run in runs[1:]:
            other = run.select(*[F.col(c).alias(f"{c}_") for c in run.columns])
            both = both.join(other, F.expr("h1 = h1_ AND h2 = h2_"), "full").select(
                *[F.coalesce(c, f"{c}_").alias(c) for c in HASH],
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n_docs_", F.lit(0))).alias("n_docs"),
                F.greatest("keeper", "keeper_").alias("keeper"),
            )
        return both

    def settled(self) -> DataFrame:
        """(h1, h2, keeper) of the lines found in ``min_docs`` documents or more."""
        runs = [r for level in self.levels for r in level]
        return self._merge(runs).where(F.col("n_docs") >= self.min_docs).select(*HASH, "keeper")


def _rest(batches):
    for batch in batches:
        sizes, dropped, kept = [], [], []
        for text, gone in zip(column(batch, "text").to_pylist(), column(batch, "gone")):
            lines = (text or "").split("\n")
            sizes.append(len(lines))
            at = gone.values.flatten().to_numpy() if gone.is_valid else ()
            dropped.append(len(at))
            if len(at):
                stay = np.ones(len(lines), dtype=bool)
                stay[at] = False
                text = "\n".join(lines[i] for i in np.flatnonzero(stay))
            kept.append(text or "")
        arrays = [column(batch, "row"), pa.array(kept, pa.string()), pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["row", "kept", "n_lines", "n_dropped"])


def drop_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 2, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Per row of ``docs``: ``row`` (the row itself, as a struct), kept (the text that is left), n_lines and n_dropped.

    A line's key is the line without ASCII white space at its ends and with A-Z in lower case. Lines whose key has
    ``min_chars`` code points or more and stands in ``min_docs`` rows or more go, but for those of the largest doc_id that
    holds the key. Batches are ranges of doc_id, the largest first.

    A null or empty text is one empty line and keeps an empty text. Every row counts as a document, rows of one doc_id too, and
    all rows of the largest doc_id keep their lines; a null doc_id counts as smaller than any other. A key that one row holds
    several times counts once and goes or stays in all its lines. An empty table gives no rows. Columns of any name may
    stand in ``docs``.
    """
    spark = docs.sparkSession
    k, th = key_of(docs, doc_id, text)
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(k, th, F.col(text).alias("text"))
    buckets = shards_for(keyed, "text", shard_bytes)
    path = scratch_path(spark, "lines")
    keyed.mapInArrow(_lines(min_chars), LINES_SQL).write.parquet(path)
    lines = spark.read.parquet(path)
    cuts = lines.agg(F.percentile_approx("k", [i / batches for i in range(1, batches)])).first()[0] or []
    runs = LineRuns(spark, buckets, min_docs, fanout)
    edges = [None, *sorted(set(cuts)), None]
    for low, high in reversed(list(zip(edges, edges[1:]))):
        batch = lines
        if low is not None:
            batch = batch.where(F.col("k") > low)
        if high is not None:
            batch = batch.where(F.col("k") <= high)
        runs.add(batch.select(*HASH, "k"))
    # written, so that a join with a frequent line can be cut: beside a bucketed table it could not
    path = scratch_path(spark, "settled")
    runs.settled().write.parquet(path)
    # rows of one key have equal lines: a set brings each line's places once, however many rows there are
    gone = lines.join(spark.read.parquet(path), HASH).where("k < keeper").groupBy("k", "th").agg(F.collect_set("at").alias("gone"))
    rows = docs.select(k, th, F.col(text).alias("text"), columns.alias("row")).join(gone, ["k", "th"], "left")
    out = StructType([StructField("row", docs.schema), *StructType.fromDDL("kept string, n_lines long, n_dropped long")])
    return rows.select("text", "gone", "row").mapInArrow(_rest, out)


def digest(result: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return result.select(F.col(f"row.{doc_id}").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
