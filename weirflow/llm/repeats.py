"""Seed and extend over shards: the frame that the two operators on repeated passages share.

A rule names, for every string of a fixed length, one seed inside it, chosen by the string alone; equal strings thus share
their seed, and a seed found in one place only rules out all strings that name it.

1. Seeds are dealt by their hash. Of a seed that a piece holds more than once, one occurrence is sent.
2. A seed with two places or more is open, and its places go back to their documents, as runs.
3. Open places are extended: what a place's strings need to be compared goes to the seed's shard, again one of equal ones
   from each piece.
4. The shard finds the repeated strings and gives their starts back.

Positions that a shard finds travel in one parcel for each shard of documents. No step pairs places with each other, and a piece sends equal things once, so a passage in a third of all documents costs
its shard one row for each piece. Documents are shuffled once: both joins on the document use the same exchange.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.texts import NULL_ID, key_of, mix, pack, pieces, unpack

ROUTED = pa.schema([("shard", pa.int32()), ("found", pa.bool_()), ("blob", pa.binary())])
ROUTED_SQL = "shard int, found boolean, blob binary"
STARTS_SQL = "k long, th long, at binary"


def found_rows(k: np.ndarray, th: np.ndarray, row: np.ndarray, at: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Keys, counts and positions (with what stands beside them) of the rows that have any; ``row`` may be in any order."""
    order = np.lexsort((at, row))
    row, at = row[order], np.stack([x[order].astype(np.int32) for x in (at, *more)], axis=1)
    cuts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else row[:0]
    return k[row[cuts]], th[row[cuts]], np.diff(np.append(cuts, len(row))).astype(np.int32) * at.shape[1], at.ravel()


def joined(founds: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(x) for x in zip(*founds))


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The items of the spans, one span after the other."""
    ends = np.cumsum(size)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)]


def found_blobs(found: tuple[np.ndarray, ...], shards: int) -> list[tuple[int, bytes]]:
    """The rows by the shard of their document."""
    k, th, n, data = found
    shard = (mix(k.view(np.uint64) ^ th.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
    return [(s, pack(*rest, gather(data, start, rest[-1]))) for s, (*rest, start) in split_by(shard, shards, k, th, n, np.cumsum(n) - n)]


def routed(blobs: list[tuple[int, bytes]], found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    rows = [(s, False, b) for s, b in blobs] + [(s, True, b) for s, b in found]
    columns = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, ROUTED)], schema=ROUTED)


def split_by(shard: np.ndarray, shards: int, *arrays: np.ndarray) -> list[tuple[int, tuple[np.ndarray, ...]]]:
    """The arrays' parts by shard; order within a shard is kept."""
    order = np.argsort(shard.astype(np.uint16) if shards <= 65536 else shard, kind="stable")
    ends = np.cumsum(np.bincount(shard, minlength=shards))
    parts = []
    for s in range(shards):
        a, b = (ends[s - 1] if s else 0), ends[s]
        if a < b:
            parts.append((s, tuple(x[order[a:b]] for x in arrays)))
    return parts


def answer(routed_rows: DataFrame, shards: int, solve: Callable[[list[tuple]], tuple[np.ndarray, ...]]) -> DataFrame:
    """One row for each document with positions: the given ones and those that ``solve`` finds in each shard's blobs."""

    def solved(batches):
        blobs: dict[int, list] = {}
        for batch in batches:
            found = batch.column(1)
            yield batch.filter(found)
            sent = batch.filter(pc.invert(found))
            for s, b in zip(sent.column(0).to_pylist(), sent.column(2)):
                blobs.setdefault(s, []).append(b)
        while blobs:
            yield routed([], found_blobs(solve([unpack(b.as_buffer()) for b in blobs.popitem()[1]]), shards))

    def by_document(batches):
        founds = [unpack(b.as_buffer()) for batch in batches for b in batch.column(2)]
        if founds:
            k, th, n, data = joined(founds)
            order = np.lexsort((th, k))
            k, th, n, data = k[order], th[order], n[order], gather(data, (np.cumsum(n) - n)[order], n[order])
            new = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (th[1:] != th[:-1]))))
            ends = np.cumsum(n)
            cuts = (ends - n)[new].tolist() + [len(data)]
            at = pa.array([data[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(k[new]), pa.array(th[new]), at], names=["k", "th", "at"])

    found = routed_rows.repartition(shards, "shard").mapInArrow(solved, ROUTED_SQL)
    return found.repartition(shards, "shard").mapInArrow(by_document, STARTS_SQL)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(*key_of(docs, doc_id, text), F.col(text).alias("text"))


def repeated_starts(
    documents: DataFrame,
    shards: int,
    seeds: Callable[[pa.RecordBatch], tuple],
    open_seeds: Callable[[list[tuple]], list],
    extend: Callable[[pa.RecordBatch], tuple],
    repeated: Callable[[list[tuple]], list],
) -> DataFrame:
    """(k, th, at): for each document with repeated strings, the packed starts of these strings."""

    def mapped(make):
        def work(batches):
            for piece in pieces(batches):
                blobs, found = make(piece)
                yield routed(blobs, found_blobs(found, shards))

        return work

    opened = answer(documents.mapInArrow(mapped(seeds), ROUTED_SQL), shards, open_seeds)
    with_open = documents.join(opened, ["k", "th"])
    return answer(with_open.mapInArrow(mapped(extend), ROUTED_SQL), shards, repeated)


def numbers(cell: pa.BinaryScalar) -> np.ndarray:
    """The whole numbers of a packed array."""
    return np.frombuffer(cell.as_buffer(), dtype=np.int32)


def id_of(k: str) -> Column:
    """The doc_id that a key stands for."""
    return F.when(F.col(k) != NULL_ID, F.col(k)).alias("doc_id")


def blob_rows(parts: list[tuple[int, tuple]], *shared: np.ndarray) -> list[tuple[int, bytes]]:
    return [(s, pack(*shared, *arrays)) for s, arrays in parts]


def found_in(blobs: list[tuple], blob: np.ndarray, row: np.ndarray, *at: np.ndarray) -> tuple[np.ndarray, ...]:
    """``found_rows`` of all blobs, each of which starts with the keys of its rows; ``blob`` must be in order."""
    ends = np.searchsorted(blob, np.arange(len(blobs) + 1))
    return joined([found_rows(b[0], b[1], row[i:j], *(a[i:j] for a in at)) for b, i, j in zip(blobs, ends, ends[1:])])
