"""Substring de-duplication: seed on winnowed anchors, compare the windows around open ones, drop passages that an earlier document holds.

A window of ``length`` words holds ``length - gram + 1`` runs of ``gram`` words; the run with the smallest hash, the last
among equals, is its anchor. Equal windows share their anchor at the same place, so a passage can only repeat around
anchors that two documents hold. These anchors are joined across documents (the seeds). No pair of places is extended word
by word: the windows to the left and right that have an open anchor meet by the hash of the whole window, and the
windows' union is what the maximal matches of ``length`` words or more cover.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.repeats import blob_rows, found_in, found_rows, id_of, keyed, numbers, repeated_starts, split_by
from weirflow.llm.texts import Words, column, longs, last_minimum, pieces, shards_for, utf8, word_runs

SHARD_BYTES = 24_000_000
OUT_SQL = "doc_id long, n_words long, removed array<struct<start:int,end:int>>, kept string"


class _Anchors:
    """The windows of a piece and the anchor of each."""

    def __init__(self, piece: pa.RecordBatch, length: int, gram: int):
        data, offsets = utf8(column(piece, "text"))
        words = Words(data, offsets)
        self.runs = word_runs(words.hashes(data))
        self.words = words
        n = len(words.start)
        self.hash = self.runs.all(gram)
        starts = np.arange(max(n - length + 1, 0))
        self.starts = starts[words.row[: len(starts)] == words.row[length - 1 :]] if len(starts) else starts
        self.anchor = last_minimum(self.hash, length - gram + 1)[self.starts] if len(starts) else starts

    def seeds(self) -> np.ndarray:
        return np.unique(self.anchor)


def _seeds(piece, length: int, gram: int, shards: int):
    """The anchors of a piece; those that two of its documents hold are open at once, and one of their places is sent."""
    a = _Anchors(piece, length, gram)
    k, th = longs(piece, "k"), longs(piece, "th")
    seed = a.seeds()
    row, hashes = a.words.row[seed], a.hash[seed]
    order = np.argsort(hashes, kind="stable")
    new = np.concatenate(([True], hashes[order][1:] != hashes[order][:-1])) if len(seed) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    firsts = order[new]
    open_group = np.zeros(len(firsts), dtype=bool)
    open_group[group[row[order] != row[firsts][group]]] = True
    local = order[open_group[group]] if len(seed) else order
    found = found_rows(k, th, row[local], seed[local] - a.words.at[row[local]])
    # a seed that one document holds several times is sent with all its places, since another piece may open it
    sent = np.sort(np.concatenate((firsts[open_group], order[~open_group[group]]))) if len(seed) else firsts
    parts = split_by((hashes[sent] % np.uint64(shards)).astype(np.int64), shards, hashes[sent], row[sent].astype(np.int32), (seed[sent] - a.words.at[row[sent]]).astype(np.int32))
    return blob_rows(parts, k, th), found


def _open_seeds(blobs):
    """Places of hashes that come from two pieces or more."""
    blob = np.repeat(np.arange(len(blobs)), [len(b[2]) for b in blobs])
    hashes, row, at = (np.concatenate([b[i] for b in blobs]) for i in (2, 3, 4))
    order = np.lexsort((blob, hashes))
    _, first, group = np.unique(hashes[order], return_index=True, return_inverse=True)
    last = np.append(first[1:], len(order)) - 1
    hit = np.zeros(len(order), dtype=bool)
    hit[order] = (blob[order[first]] != blob[order[last]])[group]
    return found_in(blobs, blob[hit], row[hit], at[hit])


def _extend(piece, length: int, gram: int, shards: int):
    """The windows around open anchors. Of equal windows of a piece only those of the first document are sent."""
    a = _Anchors(piece, length, gram)
    k, th = longs(piece, "k"), longs(piece, "th")
    is_open = np.zeros(len(a.words.start) + 1, dtype=bool)
    for row, cell in enumerate(column(piece, "at")):
        is_open[a.words.at[row] + np.unique(numbers(cell))] = True
    keep = is_open[a.anchor]
    starts, anchor = a.starts[keep], a.anchor[keep]
    row = a.words.row[starts]
    window = a.runs.hash(starts, starts + length)
    order = np.lexsort((k[row], window))
    w = window[order]
    new = np.concatenate(([True], w[1:] != w[:-1])) if len(w) else np.zeros(0, bool)
    first = k[row][order][new][np.cumsum(new) - 1] if len(w) else k[:0]
    later = k[row][order] > first
    local, sent = order[later], np.sort(order[~later])
    found = found_rows(k, th, row[local], starts[local] - a.words.at[row[local]])
    shard = (a.hash[anchor[sent]] % np.uint64(shards)).astype(np.int64)
    parts = split_by(shard, shards, window[sent], row[sent].astype(np.int32), (starts[sent] - a.words.at[row[sent]]).astype(np.int32))
    return blob_rows(parts, k, th), found


def _repeated(blobs):
    """Windows that a document with a smaller key holds too."""
    blob = np.repeat(np.arange(len(blobs)), [len(b[2]) for b in blobs])
    window, row, at = (np.concatenate([b[i] for b in blobs]) for i in (2, 3, 4))
    k = np.concatenate([b[0][b[3]] for b in blobs])
    order = np.lexsort((k, window))
    w = window[order]
    new = np.concatenate(([True], w[1:] != w[:-1])) if len(w) else np.zeros(0, bool)
    hit = np.zeros(len(w), dtype=bool)
    hit[order] = k[order] > k[order][new][np.cumsum(new) - 1]
    return found_in(blobs, blob[hit], row[hit], at[hit])


def spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs covered by ``length`` places from each of the sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] - starts[:-1] > length) + 1
    return list(zip(starts[np.append(0, cut)].tolist(), (starts[np.append(cut - 1, len(starts) - 1)] + length).tolist()))


def _cut(length: int):
    def work(batches):
        out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.large_binary())])
        for batch in batches:
            for piece in pieces([batch]):
                counts, removed, kept = [], [], []
                for text, cell in zip(column(piece, "text").cast(pa.large_binary()).to_pylist(), column(piece, "at")):
                    words = (text or b"").split()
                    runs = spans(np.unique(numbers(cell)), length) if cell.is_valid else []
                    counts.append(len(words))
                    removed.append([{"start": a, "end": b} for a, b in runs])
                    for a, b in reversed(runs):
                        del words[a:b]
                    kept.append(b" ".join(words))
                arrays = [column(piece, "doc_id"), pa.array(counts, pa.int64()), pa.array(removed, out.field(2).type), pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    return work


def drop_repeated_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 13, gram: int = 5, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, the removed runs of words [start, end), and the kept words joined by blanks.

    A word goes if a window of ``length`` consecutive words that covers it also starts in a row with a smaller doc_id. Words
    are runs of anything but ASCII white space, compared as they are. Windows are judged on the input and never cross rows.

    Null or empty texts have no words and keep an empty text. A null doc_id counts as smaller than any other; rows of one
    doc_id (or several null ones) don't remove each other's words, and each row is answered for itself. Repeats inside
    one row stay. Texts of fewer than ``length`` words stay whole. An empty table gives no rows. Other columns are left out.
    """
    if not 0 < gram <= length:
        raise ValueError("gram must be between 1 and length")
    documents = keyed(docs, doc_id, text)
    shards = shards_for(documents, "text", shard_bytes)
    starts = repeated_starts(
        documents,
        shards,
        lambda piece: _seeds(piece, length, gram, shards),
        _open_seeds,
        lambda piece: _extend(piece, length, gram, shards),
        _repeated,
    )
    return documents.join(starts, ["k", "th"], "left").select(id_of("k"), "text", "at").mapInArrow(_cut(length), OUT_SQL)


def digest(result: DataFrame) -> DataFrame:
    """The counts and the hash of the kept text."""
    removed = F.expr("aggregate(removed, 0L, (n, r) -> n + r.end - r.start)")
    return result.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
