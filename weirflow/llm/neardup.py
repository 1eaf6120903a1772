"""Similarity join on word n-grams with Bayesian pruning.

Documents with the same words are one text. Texts whose MinHash values agree in all rows of a band meet in a bucket. Pairs of
a bucket are compared a few MinHash values at a time; after each step, pairs whose posterior probability of reaching the
threshold (uniform prior) has fallen below the tolerance are dropped. What survives is verified on the whole sets.

A bucket is cut into cells of bounded size: its members are dealt into chunks, and a cell joins two of them. Pairs live in a
task's memory only; a cell answers with one row for each linked member: its links, and the smallest member it hangs on.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.components import components
from weirflow.llm.texts import NULL_ID, Words, column, key_of, mix, pieces, shards_for, utf8, word_runs
from weirflow.session import scratch_path

BANDS, ROWS, STEP = 24, 4, 16
CHUNK = 1024
SHARD_BYTES = 24_000_000
#: Text that is hashed at once: the numbers of all its words and values take some ten times as much.
SIGN_BYTES = 400_000
_SEEDS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
SLOPES, SHIFTS = _SEEDS[::2] | np.uint64(1), _SEEDS[1::2]


def least_matches(seen: int, threshold: float, tolerance: float) -> int:
    """The fewest matches of ``seen`` MinHash values with which a pair may still reach the threshold.

    With a uniform prior the posterior of similarity >= t after m matches of n is P(Binomial(n + 1, t) <= m).
    """
    below = 0.0
    for m in range(seen + 1):
        below += math.comb(seen + 1, m) * threshold**m * (1 - threshold) ** (seen + 1 - m)
        if below >= tolerance:
            return m
    return seen


class Shingles:
    """The n-grams of words of a piece's rows as sorted sets of hashes; fewer words than n make one gram."""

    def __init__(self, texts: pa.Array, n: int):
        data, offsets = utf8(texts)
        words = Words(data, offsets)
        hashes = words.hashes(data)
        self.n_words = np.diff(words.at)
        runs = word_runs(hashes)
        self.text = runs.hash(words.at[:-1], words.at[1:])
        starts = np.arange(len(hashes))
        ends = np.minimum(starts + n, words.at[words.row + 1])
        keep = (ends - starts == n) | (starts == words.at[words.row])
        keep &= (ends - starts == n) | (self.n_words[words.row] < n)
        self.row = words.row[keep]
        self.hash = runs.hash(starts[keep], ends[keep])
        self.at = np.searchsorted(self.row, np.arange(len(offsets)))

    def signatures(self) -> np.ndarray:
        """One row of MinHash values for each row with words; zeros for the others."""
        out = np.zeros((len(self.at) - 1, len(SLOPES)), dtype=np.uint32)
        filled = np.flatnonzero(np.diff(self.at))
        if len(filled):
            for i, (a, b) in enumerate(zip(SLOPES, SHIFTS)):
                values = ((self.hash * a + b) >> np.uint64(32)).astype(np.uint32)
                out[filled, i] = np.minimum.reduceat(values, self.at[:-1][filled])
        return out

    def sets(self) -> list[np.ndarray]:
        return [np.unique(self.hash[a:b]) for a, b in zip(self.at, self.at[1:])]


def _sign(n: int):
    def work(batches):
        for piece in pieces(batches, limit=SIGN_BYTES):
            s = Shingles(column(piece, "text"), n)
            keep = s.n_words > 0
            signatures = s.signatures()[keep]
            arrays = [column(piece, c).filter(pa.array(keep)) for c in ("k", "th")]
            arrays += [pa.array(s.text[keep].view(np.int64)), pa.array([x.tobytes() for x in signatures], pa.binary())]
            bands = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
            key = np.arange(BANDS, dtype=np.uint64) + np.zeros((len(bands), 1), np.uint64)
            for r in range(ROWS):
                key = mix(key * np.uint64(31) + bands[:, :, r])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1) * BANDS, pa.int32()), pa.array(key.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([*arrays, lists], names=["k", "th", "c", "signature", "keys"])
            del s, arrays, bands, key, lists
            pa.default_memory_pool().release_unused()

    return work


def _survivors(signatures: np.ndarray, band: np.ndarray, chunk: np.ndarray, cross: np.ndarray, group: np.ndarray, least: list[int], pairs_at_once: int = 200_000):
    """Pairs (i, j) of rows of a group that meet in no earlier band and survive all comparisons.

    ``group`` is sorted; where ``cross`` is set only pairs of two different chunks count.
    """
    n = len(group)
    ends = np.searchsorted(group, group, side="right")
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for step in range(1, int((ends - np.arange(n)).max()) if n else 0):
        i = np.flatnonzero(np.arange(n) + step < ends)
        j = i + step
        keep = ~cross[i] | (chunk[i] != chunk[j])
        waiting.append((i[keep], j[keep]))
        held += len(waiting[-1][0])
        if held > pairs_at_once:
            yield _compared(signatures, band, *map(np.concatenate, zip(*waiting)), least, pairs_at_once)
            waiting, held = [], 0
    if held:
        yield _compared(signatures, band, *map(np.concatenate, zip(*waiting)), least, pairs_at_once)


def _compared(signatures, band, i, j, least, pairs_at_once):
    kept = [(i[:0], j[:0])]
    for a in range(0, len(i), pairs_at_once):
        x, y = i[a : a + pairs_at_once], j[a : a + pairs_at_once]
        matches = np.zeros(len(x), dtype=np.int32)
        for number, need in enumerate(least):
            part = slice(number * STEP, (number + 1) * STEP)
            equal = signatures[x, part] == signatures[y, part]
            matches += equal.sum(axis=1, dtype=np.int32)
            met = equal.reshape(len(x), STEP // ROWS, ROWS).all(axis=2)
            earlier = (met & (number * STEP // ROWS + np.arange(met.shape[1]) < band[x][:, None])).any(axis=1)
            stay = (matches >= need) & ~earlier
            x, y, matches = x[stay], y[stay], matches[stay]
        kept.append((x, y))
    return tuple(np.concatenate(c) for c in zip(*kept))


def _groups(batches, limit_rows: int, limit_bytes: int):
    """Tables of whole cells from sorted batches, of about the limits, or of one cell."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows < limit_rows and size < limit_bytes:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cell = _cell(table)
        last = int(np.searchsorted(cell, cell[-1]))
        if last:
            yield table.slice(0, last), cell[:last]
        held = table.slice(last).to_batches()
        rows, size = table.num_rows - last, sum(b.nbytes for b in held)
    if rows:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _cell(table)


def _cell(table: pa.Table) -> np.ndarray:
    """A rising number for each cell of rows sorted by (bk, low, high)."""
    columns = [table.column(c).to_numpy() for c in ("bk", "low", "high")]
    change = np.zeros(table.num_rows, dtype=bool)
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.cumsum(change)


def _rows_of(table: pa.Table):
    signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint32).reshape(table.num_rows, -1)
    low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
    return signatures, table.column("band").to_numpy(), table.column("chunk").to_numpy(), low != high


def _prune(least: list[int]):
    def work(batches):
        for table, cell in _groups(batches, 20_000, 8_000_000):
            alive = np.zeros(table.num_rows, dtype=bool)
            for i, j in _survivors(*_rows_of(table), cell, least):
                alive[i] = alive[j] = True
            yield from table.filter(pa.array(alive)).to_batches()

    return work


def _verify(n: int, threshold: float, least: list[int]):
    def work(batches):
        for table, cell in _groups(batches, 5_000, 3_000_000):
            c, weight = table.column("c").to_numpy(), table.column("m").to_numpy()
            order = np.lexsort((c, cell))  # equal rows of one doc_id bring the text twice
            twice = np.concatenate(([False], (c[order][1:] == c[order][:-1]) & (cell[order][1:] == cell[order][:-1])))
            keep = np.ones(len(c), dtype=bool)
            keep[order[twice]] = False
            table, cell, c, weight = table.filter(pa.array(keep)), cell[keep], c[keep], weight[keep]
            sets = Shingles(table.column("text").combine_chunks(), n).sets()
            sizes = np.array([len(s) for s in sets])
            links = np.zeros(len(c), dtype=np.int64)
            root = np.arange(len(c))
            for i, j in _survivors(*_rows_of(table), cell, least):
                common = _common(sets, i, j, cell)
                hit = common >= threshold * (sizes[i] + sizes[j] - common)
                i, j = i[hit], j[hit]
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                _hang(root, i, j)
            linked = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(c[linked]), pa.array(c[root[linked]]), pa.array(links[linked])], names=["a", "b", "links"])

    return work


def _hang(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of i and j; every node hangs on its root."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, cell: np.ndarray, wide: int = 16_384, pairs_at_once: int = 20_000) -> np.ndarray:
    """The size of the common part of each pair of sets, exactly."""
    out = np.zeros(len(i), dtype=np.int64)
    if not len(i):
        return out
    order = np.argsort(cell[i], kind="stable")
    cuts = np.flatnonzero(np.diff(cell[i][order])) + 1
    for pairs in np.split(order, cuts):
        rows, both = np.unique(np.concatenate((i[pairs], j[pairs])), return_inverse=True)
        if len(pairs) < 2 * len(rows):
            out[pairs] = [len(sets[x]) + len(sets[y]) - len(np.union1d(sets[x], sets[y])) for x, y in zip(i[pairs], j[pairs])]
            continue
        x, y = both[: len(pairs)], both[len(pairs) :]
        member = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
        values, number, count = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
        shared = count > 1
        column_of = np.cumsum(shared) - 1
        member, number = member[shared[number]], column_of[number[shared[number]]]
        for low in range(0, int(shared.sum()), wide):
            inside = (number >= low) & (number < low + wide)
            table = np.zeros((len(rows), wide), dtype=bool)
            table[member[inside], number[inside] - low] = True
            bits = np.packbits(table, axis=1).view(np.uint64)
            bits = bits[:, : -(-min(wide, int(shared.sum()) - low) // 64)]
            for a in range(0, len(pairs), pairs_at_once):
                part = slice(a, a + pairs_at_once)
                out[pairs[part]] += np.bitwise_count(bits[x[part]] & bits[y[part]]).sum(axis=1, dtype=np.int64)
    return out


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8, tolerance: float = 1e-6, chunk: int = CHUNK, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Per row of ``docs``: k and th (its key, see ``key_of``), doc_id, class_id, n_links and keeps.

    Two rows are linked if the Jaccard similarity of their sets of ``n``-grams of words is ``threshold`` or more; ``n_links``
    counts the linked rows, copies included. ``class_id`` is the smallest doc_id of all rows that links lead to, and
    ``keeps`` marks the row of each class to be kept (the one with the smallest doc_id; equal rows of one doc_id are both marked).
    Words are runs of anything but ASCII white space, compared as they are.

    A text of fewer than ``n`` words has one gram, all its words. Null, empty and blank texts have none, link to nothing and
    are classes of their own. A null doc_id counts as smaller than any other; a class that holds one has a null class_id.
    Rows of one doc_id are rows of their own. An empty table gives no rows. Other columns are left out.
    """
    spark = docs.sparkSession
    keyed = docs.select(*key_of(docs, doc_id, text), F.col(text).alias("text"))
    shards = shards_for(keyed, "text", shard_bytes)
    least = [least_matches((i + 1) * STEP, threshold, tolerance) for i in range(BANDS * ROWS // STEP)]
    path = scratch_path(spark, "signatures")
    keyed.mapInArrow(_sign(n), "k long, th long, c long, signature binary, keys array<long>").write.parquet(path)
    signed = spark.read.parquet(path)
    first = F.min(F.struct("k", "th")).alias("first")
    texts = signed.groupBy("c").agg(first, F.count("*").alias("m"))
    members = signed.join(texts, "c").where("k = first.k AND th = first.th").dropDuplicates(["c"])
    path = scratch_path(spark, "texts")
    members.select("c", "k", "th", "m", "signature", "keys").write.parquet(path)
    texts = spark.read.parquet(path)

    bands = texts.select("c", F.posexplode("keys").alias("band", "bk"))
    full = bands.groupBy("bk").agg(F.count("*").alias("n")).where("n > 1")
    met = bands.join(full, "bk")
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    met = met.withColumn("chunk", F.pmod(F.hash("c"), chunks)).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    met = met.select("c", "band", "bk", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    cell = ["bk", "low", "high"]
    with_signature = met.join(texts.select("c", "k", "th", "m", "signature"), "c")
    pruned_type = "c long, band int, bk long, chunk int, low int, high int, k long, th long, m long, signature binary"
    dealt = with_signature.repartition(shards, *cell).sortWithinPartitions(*cell)
    pruned = dealt.mapInArrow(_prune(least), pruned_type)
    with_text = pruned.join(keyed, ["k", "th"])
    dealt = with_text.drop("k", "th").repartition(shards, *cell).sortWithinPartitions(*cell)
    path = scratch_path(spark, "links")
    dealt.mapInArrow(_verify(n, threshold, least), "a long, b long, links long").write.parquet(path)
    links = spark.read.parquet(path)

    labels = components(links.select("a", "b"))
    counts = links.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "node")
    classes = texts.select("c", "k", "th", "m").join(labels.join(counts, "node").withColumnRenamed("node", "c"), "c", "left")
    classes = classes.withColumn("label", F.coalesce("label", "c"))
    heads = classes.groupBy("label").agg(F.min(F.struct("k", "th")).alias("head"))
    classes = classes.join(heads, "label").select("c", "head", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    answers = signed.select("k", "th", "c").join(classes, "c").groupBy("k", "th").agg(F.first("head").alias("head"), F.first("n_links").alias("n_links"))
    rows = docs.select(*key_of(docs, doc_id, text)).join(answers, ["k", "th"], "left")
    head = F.coalesce(F.col("head.k"), F.col("k"))
    return rows.select(
        "k",
        "th",
        F.when(F.col("k") != NULL_ID, F.col("k")).alias("doc_id"),
        F.when(head != NULL_ID, head).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("head").isNull() | ((F.col("head.k") == F.col("k")) & (F.col("head.th") == F.col("th")))).alias("keeps"),
    )
