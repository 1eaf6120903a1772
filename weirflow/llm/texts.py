"""Whole texts as numpy arrays: bytes, words, hashes of runs of words or bytes, and lists of runs.

The functions work on pieces of an Arrow batch, a few megabytes each, so that memory stays bounded whatever the batch
holds; one text is never cut. Hashes are polynomials modulo 2**64 over prefix sums, finished by a mixing step, so a hash of
any run costs two look-ups.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The smallest long: the key that stands for a doc_id of null. It is smaller than every real doc_id.
NULL_ID = -(2**63)
PIECE_BYTES = 2_000_000

#: The white space that separates words, tab to carriage return and blank.
SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True

BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xD1342543DE82EF95)


class Powers:
    """base**i and base**-i modulo 2**64, kept and extended as longer runs come."""

    def __init__(self, base: np.uint64):
        self.base = base
        self.inverse = np.uint64(pow(int(base), -1, 2**64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up, self.down


_BYTES, _WORDS = Powers(BYTE_BASE), Powers(WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of whole numbers (the finishing step of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Runs:
    """Hashes of any run of a sequence of whole numbers."""

    def __init__(self, values: np.ndarray, powers: Powers):
        self.up, self.down = powers.upto(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        terms = values.astype(np.uint64)
        terms += np.uint64(1)
        terms *= self.up[: len(values)]
        np.cumsum(terms, out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def all(self, width: int) -> np.ndarray:
        """The hash of every run of ``width``."""
        n = max(len(self.sums) - width, 0)
        out = self.sums[width:] - self.sums[:n] if n else self.sums[:0].copy()
        out *= self.down[:n]
        out += np.uint64(width)
        return mix(out)


def byte_runs(data: np.ndarray) -> Runs:
    return Runs(data, _BYTES)


def word_runs(hashes: np.ndarray) -> Runs:
    return Runs(hashes, _WORDS)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts and the offsets of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and len(at) else np.zeros(0, np.uint8)
    return body, at - at[0]


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``limit`` bytes of text, or of one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def longs(batch: pa.RecordBatch, name: str, null: int = NULL_ID) -> np.ndarray:
    return pc.fill_null(column(batch, name).cast(pa.int64()), null).to_numpy(zero_copy_only=False)


class Words:
    """The words of a piece: their bytes' spans, the row of each, and where each row's words start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        solid = ~IS_SPACE[data]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        filled = offsets[:-1] < offsets[1:]
        first[offsets[:-1][filled]] = solid[offsets[:-1][filled]]
        last[offsets[1:][filled] - 1] = solid[offsets[1:][filled] - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.at = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.at))

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return byte_runs(data).hash(self.start, self.end)


def last_minimum(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each start, the position of the smallest of ``width`` hashes (by their upper half), the last one among equals."""
    if len(hashes) < width:
        return np.zeros(0, dtype=np.int64)
    low = np.uint64(2**32 - 1)
    best = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    done = 1
    while done < width:
        step = min(done, width - done)
        best = np.minimum(best[: len(best) - step], best[step:])
        done += step
    return (low - (best & low)).astype(np.int64)


def pack(*arrays: np.ndarray) -> bytes:
    return pickle.dumps(arrays, protocol=5)


def unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(blob)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def key_of(docs: DataFrame, doc_id: str, text: str) -> list[Column]:
    """A row's key: its doc_id, and a hash of its text, of 64 bits, that tells apart rows of one doc_id."""
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("k"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"),
    ]


def shards_for(docs: DataFrame, text: str, bytes_each: int) -> int:
    """Shuffle partitions for work on a column of texts: at least Spark's own number, and more as the texts grow."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-int(total) // bytes_each))
