"""Suffix-array de-duplication of bytes by prefix-free parsing.

A rolling hash over ``trigger`` bytes cuts every text into phrases: a phrase ends in a trigger, a place whose hash is the
smallest of some string of ``length`` bytes (the last one among equals). Taking local minima in place of a fixed residue
makes sure that every such string holds a trigger, however long a text goes on without a residue.

A suffix of the corpus is then a suffix of a phrase from the dictionary, up to its trigger, followed by the parse from
this trigger on. Suffixes of equal strings share their trigger, so they are dealt by it. For the suffixes of a trigger, a
shard builds two suffix arrays with the lengths of common prefixes: one of what stands before the trigger, read backwards
(the dictionary), one of what follows (the parse). A string of ``length`` bytes is a place in both, and two strings are
equal if they share the classes that these lengths cut out of the two arrays at their depths. This is the corpus
order as far as ``length`` bytes, by comparing bytes, not hashes.

Phrases whose trigger stands in one place only cannot hold a repeated string and never leave the first step; equal
surroundings within a piece of the corpus are sent once. So the work follows the distinct text, which is what makes
prefix-free parsing fit for repetitive corpora.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.repeats import blob_rows, found_in, found_rows, gather, id_of, joined, keyed, numbers, repeated_starts, split_by
from weirflow.llm.texts import byte_runs, column, last_minimum, longs, pack, pieces, shards_for, utf8

SHARD_BYTES = 24_000_000
OUT_SQL = "doc_id long, n_bytes long, removed array<struct<start:int,end:int>>, kept binary"


class _Parse:
    """The triggers of a piece: place, row, hash, and the first and last start of the strings that name the trigger."""

    def __init__(self, piece: pa.RecordBatch, length: int, trigger: int):
        self.data, self.offsets = utf8(column(piece, "text"))
        self.runs = byte_runs(self.data)
        sizes = np.diff(self.offsets)
        hashes = self.runs.all(trigger)
        named = last_minimum(hashes, length - trigger + 1)
        ends = np.repeat(self.offsets[1:], sizes)[: len(named)]
        starts = np.flatnonzero(np.arange(len(named)) + length <= ends)
        named = named[starts]
        new = np.concatenate(([True], named[1:] != named[:-1])) if len(named) else np.zeros(0, bool)
        self.place = named[new]
        self.low = starts[new]
        self.high = starts[np.append(np.flatnonzero(new)[1:], len(named)) - 1] if len(named) else starts
        self.hash = hashes[self.place]
        self.row = np.searchsorted(self.offsets, self.place, side="right") - 1


def _equal_runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order, group of each in this order, and the first of each group."""
    order = np.argsort(values, kind="stable")
    new = np.concatenate(([True], values[order][1:] != values[order][:-1])) if len(values) else np.zeros(0, bool)
    return order, np.cumsum(new) - 1, order[new]


def _seeds(piece, length: int, trigger: int, shards: int):
    p = _Parse(piece, length, trigger)
    k, th = longs(piece, "k"), longs(piece, "th")
    order, group, firsts = _equal_runs(p.hash)
    many = np.bincount(group, minlength=len(firsts)) > 1
    local = order[many[group]]
    found = found_rows(k, th, p.row[local], p.place[local] - p.offsets[p.row[local]])
    sent = np.sort(firsts)
    at = (p.place[sent] - p.offsets[p.row[sent]]).astype(np.int32)
    parts = split_by((p.hash[sent] % np.uint64(shards)).astype(np.int64), shards, p.hash[sent], p.row[sent].astype(np.int32), at)
    return blob_rows(parts, k, th), found


def _open_seeds(blobs):
    """Places of triggers that come from two pieces or more."""
    blob = np.repeat(np.arange(len(blobs)), [len(b[2]) for b in blobs])
    hashes, row, at = (np.concatenate([b[i] for b in blobs]) for i in (2, 3, 4))
    _, group, count = np.unique(hashes, return_inverse=True, return_counts=True)
    hit = count[group] > 1
    return found_in(blobs, blob[hit], row[hit], at[hit])


def _extend(piece, length: int, trigger: int, shards: int):
    """The surroundings of open triggers. Those that are equal within the piece repeat as a whole, and one is sent."""
    p = _Parse(piece, length, trigger)
    k, th = longs(piece, "k"), longs(piece, "th")
    is_open = np.zeros(len(p.data) + 1, dtype=bool)
    for row, cell in enumerate(column(piece, "at")):
        is_open[p.offsets[row] + numbers(cell)] = True
    keep = np.flatnonzero(is_open[p.place])
    place, low, high, row, hashes = (x[keep] for x in (p.place, p.low, p.high, p.row, p.hash))
    whole = p.runs.hash(low, high + length) * np.uint64(2 * length + 1) + (place - low).astype(np.uint64)
    order, group, firsts = _equal_runs(whole)
    local = order[(np.bincount(group, minlength=len(firsts)) > 1)[group]]
    base = p.offsets[row]
    found = found_rows(k, th, row[local], low[local] - base[local], high[local] - base[local])
    sent = np.sort(firsts)
    shard = (hashes[sent] % np.uint64(shards)).astype(np.int64)
    arrays = (hashes[sent], row[sent].astype(np.int32), (low - base)[sent].astype(np.int32), (place - low)[sent].astype(np.int16), (high - low + 1)[sent].astype(np.int16), low[sent])
    blobs = []
    for s, (*rest, start) in split_by(shard, shards, *arrays):
        blobs.append((s, pack(k, th, *rest, gather(p.data, start, rest[-1].astype(np.int64) + length - 1))))
    return blobs, found


def _suffix_array(group: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each row of bytes within the order by (group, bytes), and the common prefix of each with the one before.

    The first of a group shares -1 bytes with the one before, so that a group never joins another.
    """
    wide = np.zeros((len(text), -(-text.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : text.shape[1]] = text
    keys = wide.view(">u8").astype(np.uint64)
    order = np.lexsort((*keys.T[::-1], group))
    differ = text[order][1:] != text[order][:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), text.shape[1])
    common[group[order][1:] != group[order][:-1]] = -1
    rank = np.empty(len(text), dtype=np.int64)
    rank[order] = np.arange(len(text))
    return rank, np.concatenate(([-1], common))


def _side(data, start, size, width: int, backwards: bool, rows_at_once: int = 8192) -> np.ndarray:
    """One row of ``width`` bytes for each span, filled up with zeros."""
    out = np.zeros((len(start), width), dtype=np.uint8)
    j = np.arange(width)
    for i in range(0, len(start), rows_at_once):
        part = slice(i, i + rows_at_once)
        inside = j < size[part, None]
        at = start[part, None] + (-j - 1 if backwards else j)
        out[part] = np.where(inside, data[np.where(inside, at, 0)], 0)
    return out


def _repeated(blobs, length: int, trigger: int, rows_at_once: int = 50_000):
    """Runs of starts whose string of ``length`` bytes stands in two places or more."""
    blob = np.repeat(np.arange(len(blobs)), [len(b[2]) for b in blobs])
    hashes, row, low, before, starts = (np.concatenate([b[i] for b in blobs]) for i in (2, 3, 4, 5, 6))
    data = np.concatenate([b[7] for b in blobs])
    before, starts = before.astype(np.int64), starts.astype(np.int64)
    size = starts + length - 1
    place = np.cumsum(size) - size + before
    _, group, count = np.unique(hashes, return_inverse=True, return_counts=True)
    by_group = np.argsort(group, kind="stable")
    by_group = by_group[count[group[by_group]] > 1]
    out = [found_in(blobs, *[blob[:0]] * 4)]
    while len(by_group):
        cut = min(rows_at_once, len(by_group))
        cut = int(np.searchsorted(group[by_group], group[by_group[cut - 1]], side="right"))
        rows, by_group = np.sort(by_group[:cut]), by_group[cut:]
        hit = _classes(group[rows], data, place[rows], before[rows], starts[rows], length, trigger)
        padded = np.zeros((len(rows), hit.shape[1] + 2), dtype=np.int8)
        padded[:, 1:-1] = hit
        turn = np.diff(padded, axis=1)
        i, first = np.nonzero(turn == 1)
        _, last = np.nonzero(turn == -1)
        at = rows[i]
        out.append(found_in(blobs, blob[at], row[at], low[at] + first, low[at] + last - 1))
    return joined(out)


def _classes(group, data, place, before, starts, length: int, trigger: int) -> np.ndarray:
    """For each trigger and each of its starts, in order: whether its string stands elsewhere too."""
    most = max(length - trigger, 1)
    least = before - starts + 1  # bytes before the trigger of the last start
    left, left_common = _suffix_array(group, _side(data, place, before, most, True))
    right, right_common = _suffix_array(group, _side(data, place, length - least, length, False))
    hit = np.zeros((len(group), int(starts.max())), dtype=bool)
    for depth in range(int(before.max()) + 1):
        rows = np.flatnonzero((least <= depth) & (depth <= before))
        if len(rows) < 2:
            continue
        a = np.cumsum(left_common < depth)[left[rows]]
        b = np.cumsum(right_common < length - depth)[right[rows]]
        both = a * (len(group) + 1) + b
        order = np.argsort(both)
        same = both[order][1:] == both[order][:-1]
        shared = rows[order[np.concatenate((same, [False])) | np.concatenate(([False], same))]]
        hit[shared, before[shared] - depth] = True
    return hit


def spans(runs: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal covered spans of (first start, last start) pairs."""
    merged: list[list[int]] = []
    for first, last in sorted(runs.reshape(-1, 2).tolist()):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], last + length)
        else:
            merged.append([first, last + length])
    return [(a, b) for a, b in merged]


def _cut(length: int):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    names = ["doc_id", "n_bytes", "removed", "kept"]

    def work(batches):
        for piece in pieces(batches):
            sizes, removed, kept = [], [], []
            for text, cell in zip(column(piece, "text").cast(pa.large_binary()).to_pylist(), column(piece, "at")):
                text = text or b""
                runs = spans(numbers(cell), length) if cell.is_valid else []
                edges = [0, *(x for r in runs for x in r), len(text)]
                sizes.append(len(text))
                removed.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays([column(piece, "doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())], names=names)

    return work


def drop_repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 200, trigger: int = 32, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, the removed spans of bytes [start, end), and the kept bytes.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in any row or in the same one,
    overlapping or not. Texts are UTF-8 bytes, strings never cross rows and are judged on the input. Kept bytes can begin
    or end inside a character, so they are binary.

    Null texts are empty. Rows with the same doc_id or a null doc_id are rows of their own, and equal rows remove each other's
    bytes like any two texts. Texts shorter than ``length`` stay whole. An empty table gives no rows. Other columns are
    left out.
    """
    if not 0 < trigger <= length <= 2**14:
        raise ValueError("trigger must be between 1 and length, and length at most 16384")
    documents = keyed(docs, doc_id, text)
    shards = shards_for(documents, "text", shard_bytes)
    starts = repeated_starts(
        documents,
        shards,
        lambda piece: _seeds(piece, length, trigger, shards),
        _open_seeds,
        lambda piece: _extend(piece, length, trigger, shards),
        lambda blobs: _repeated(blobs, length, trigger),
    )
    return documents.join(starts, ["k", "th"], "left").select(id_of("k"), "text", "at").mapInArrow(_cut(length), OUT_SQL)


def digest(result: DataFrame) -> DataFrame:
    """The counts and the hash of the kept bytes."""
    removed = F.expr("aggregate(removed, 0L, (n, r) -> n + r.end - r.start)")
    return result.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
