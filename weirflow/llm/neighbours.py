"""Nearest neighbours by inner product: multiprobe hashing with p-stable projections.

Vectors get one more component so that all have the norm of the longest; then the nearest in distance has the largest inner
product. A table hashes a vector by ``width`` wide cells of ``functions`` random Gaussian projections. A query visits its own
cell of each table and then the cells next to it in the order of their estimated chance to hold neighbours: the sets of
perturbed coordinates are ranked by the expected squared distance of the query's sorted coordinates to the cell borders.

How many cells are visited, and of how many functions, is fitted on a bounded sample, so that the sample's own neighbours are
found. A query that meets too few candidates in its cells is compared with all vectors. Of equal vectors, only as many of the
smallest ids as can be asked for are indexed, which loses nothing.

A task holds a block of the vectors with their buckets of all tables, and the queries pass by; so a vector is moved once, a query
once for each block, and a pair is scored once however many cells it shares. Where a query's cells hold few of a block's
vectors, these are scored alone. Where they hold many, as in data without clusters, a matrix product in single precision comes
first, with a bound of its error, and what may be among the best and shares a cell is scored again in double precision.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from weirflow.llm.texts import column, mix
from weirflow.session import scratch_path

PROBES = (1, 2, 4, 8, 12, 16, 20, 24, 32, 48, 64, 96, 128)
#: Components of the vectors that a task holds, and queries that it answers at a time.
BLOCK = 2**24
AT_ONCE = 256
#: Vectors that are scored alone are at most this share of a block's pairs; single products cost so much more than those of a matrix.
FEW = 1 / 64
#: Powers of two beyond which a product of two components may overflow.
EXACT_EXPONENT = 256


@dataclass(frozen=True)
class Tables:
    """The projections, and the order in which a query visits the cells around its own."""

    longest: float
    dimensions: int
    tables: int = 8
    functions: int = 6
    width: float = 2.0
    probes: int = 20
    seed: int = 5

    def projections(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        a = rng.normal(size=(self.dimensions + 1, self.tables * self.functions))
        return a, rng.uniform(0, 1, self.tables * self.functions)

    def _cells(self, wide: np.ndarray) -> np.ndarray:
        a, b = self.projections()
        return (wide @ a / (self.width * self.longest) + b).reshape(len(wide), self.tables, self.functions)

    def _keys(self, cells: np.ndarray, each: int = 1) -> np.ndarray:
        """The keys of cells of shape (rows, tables x ``each``, functions)."""
        key = np.repeat(np.arange(self.tables, dtype=np.uint64), each) + np.zeros(cells.shape[:2], dtype=np.uint64)
        for f in range(self.functions):
            key = mix(key * np.uint64(1_000_003) + cells[:, :, f].astype(np.int64).view(np.uint64))
        return key.view(np.int64)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """One bucket key for each vector and table."""
        rest = np.sqrt(np.maximum(self.longest**2 - np.square(vectors).sum(axis=1), 0))
        return self._keys(np.floor(self._cells(np.column_stack((vectors, rest)))))

    @lru_cache
    def visits(self) -> list[tuple[int, ...]]:
        """Sets of ranks of perturbations, the most promising first.

        A query's 2 x functions border distances are ranked; the expected squares of ranked distances are known, and a set
        costs their sum. Ranks r and 2 x functions - 1 - r belong to the two borders of one coordinate and exclude each other.
        """
        n = self.functions
        low = [(j * (j + 1)) / (4 * (n + 1) * (n + 2)) for j in range(1, n + 1)]
        cost = low + [1 - j / (n + 1) + j * (j + 1) / (4 * (n + 1) * (n + 2)) for j in range(n, 0, -1)]
        sets = [s for size in range(n + 1) for s in itertools.combinations(range(2 * n), size) if not any(2 * n - 1 - r in s for r in s)]
        return sorted(sets, key=lambda s: (sum(cost[r] for r in s), s))[: self.probes]

    def probe_keys(self, queries: np.ndarray) -> np.ndarray:
        """The bucket keys to visit, in order, for each query: (queries, tables, probes)."""
        exact = self._cells(np.column_stack((queries, np.zeros(len(queries)))))
        cells = np.floor(exact)
        inside = exact - cells
        order = np.argsort(np.concatenate((inside, 1 - inside), axis=2), axis=2, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.broadcast_to(np.arange(2 * self.functions), order.shape), axis=2)
        chosen = np.zeros((self.probes, 2 * self.functions), dtype=np.int8)
        for probe, ranks in enumerate(self.visits()):
            chosen[probe, list(ranks)] = 1
        chosen = chosen[: len(self.visits())].T
        # one step down where the lower border's rank is chosen, one up for the upper border's
        step = chosen[rank[:, :, self.functions :]] - chosen[rank[:, :, : self.functions]]
        moved = np.moveaxis(cells[:, :, :, None] + step, 3, 2)
        return self._keys(moved.reshape(len(queries), -1, self.functions), step.shape[3]).reshape(*cells.shape[:2], -1)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, and nothing in it null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def fit_probes(tables: Tables, sample: np.ndarray, neighbours: int, queries: int = 200, recall: float = 0.96) -> Tables:
    """The fewest probes that find ``recall`` of the sample's neighbours within the sample; with fewer functions, and then more tables, if no number does."""
    if len(sample) < 2:
        return tables
    asked = sample[:queries]
    scores = asked @ sample.T
    np.fill_diagonal(scores, -np.inf)
    near = np.argsort(-scores, axis=1)[:, : min(neighbours, len(sample) - 1)]
    more = [(f, tables.tables) for f in range(tables.functions, 0, -1)] + [(1, tables.tables * 2**i) for i in range(1, 8)]
    for functions, count in more:
        widest = Tables(**{**tables.__dict__, "functions": functions, "tables": count, "probes": PROBES[-1]})
        held = widest.keys(sample)
        probed = widest.probe_keys(asked)
        first = np.full(near.shape, PROBES[-1])
        for p in range(probed.shape[2])[::-1]:
            met = (held[near] == probed[:, None, :, p]).any(axis=2)
            first[met] = p
        for probes in PROBES:
            if (first < probes).mean() >= recall:
                return Tables(**{**widest.__dict__, "probes": probes})
    return widest


def _matrix(batch: pa.RecordBatch, name: str = "v") -> np.ndarray:
    return np.array(column(batch, name).flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(batch.num_rows, -1)


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """The ``most`` best different vectors of each query, ties to the smaller id; of one id the best score counts."""
    order = np.lexsort((-score, vec, query))
    query, vec, score = query[order], vec[order], score[order]
    fresh = np.ones(len(query), dtype=bool)
    fresh[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])
    query, vec, score = query[fresh], vec[fresh], score[fresh]
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    keep = place < most
    return query[keep], vec[keep], score[keep]


def _products(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, at_once: int = 65536) -> np.ndarray:
    """Inner products of rows of ``a`` and ``b``, summed component by component as Spark does, so that equal is equal."""
    out = np.zeros(len(i))
    for start in range(0, len(i), at_once):
        part = slice(start, start + at_once)
        total = out[part]
        for x, y in zip(a[i[part]].T, b[j[part]].T):
            total += x * y
    return out


def _set_flags(flags: np.ndarray) -> np.ndarray:
    """Where flags are set, if few are: eight are looked at together."""
    if len(flags) % 8:
        return np.flatnonzero(flags)
    eight = np.flatnonzero(flags.view(np.uint64) != 0)
    row, place = np.nonzero(flags.reshape(-1, 8)[eight])
    return eight[row] * 8 + place


class Block:
    """The vectors that a task holds, longest first, and their buckets in each table; without tables, a query meets all of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, tables: Tables | None, most: int):
        norms = np.concatenate([np.linalg.norm(vectors[a : a + 16384].astype(float), axis=1) for a in range(0, len(ids), 16384)])
        order = np.argsort(-norms, kind="stable")
        self.ids, self.vectors, self.norms, self.tables, self.most = ids[order], vectors[order], norms[order], tables, most
        self.narrow = self.vectors.astype(np.float32, copy=False)
        # among so many of the best rows are ``most`` ids
        self.enough = most * int(np.unique(ids, return_counts=True)[1].max())
        self.keys, self.cells, self.members, self.sizes = [], [], [], []
        if tables:
            held = np.concatenate([tables.keys(self.vectors[a : a + 16384].astype(float)) for a in range(0, len(ids), 16384)])
            for key in held.T:
                found, cell, sizes = np.unique(key, return_inverse=True, return_counts=True)
                self.keys.append(found)
                self.cells.append(cell.astype(np.int32))
                self.members.append(np.argsort(cell, kind="stable").astype(np.int32))
                self.sizes.append(sizes)

    def search(self, query: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, ...]:
        """The best vectors that share a cell with each query: the query's row, the id and the exact score."""
        visits = self._visits(own) if self.tables else None
        if visits is not None and sum(int(size.sum()) for *_, size in visits) <= FEW * len(own) * len(self.ids):
            row, at = self._pairs(visits)
            row, at = self._others(query, row, at)
        else:
            row, at = self._dense(query, own, visits)
        return _best(row, self.ids[at], _products(own, row, self.vectors, at), self.most)

    def _others(self, query, row, at):
        """Without the vectors of the query's own id."""
        keep = self.ids[at] != query[row]
        return row[keep], at[keep]

    def _visits(self, own: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """For each table the visited cells that hold vectors: the query's row, the cell, its number of vectors."""
        visits = []
        for t, probed in enumerate(np.moveaxis(self.tables.probe_keys(own), 1, 0)):
            cell = np.minimum(np.searchsorted(self.keys[t], probed), len(self.keys[t]) - 1)
            row, probe = np.nonzero(self.keys[t][cell] == probed)
            cell = cell[row, probe]
            visits.append((row, cell, self.sizes[t][cell]))
        return visits

    def _pairs(self, visits) -> tuple[np.ndarray, np.ndarray]:
        """Each query with each vector of its cells, once."""
        pairs = []
        for t, (row, cell, size) in enumerate(visits):
            start = (np.cumsum(self.sizes[t]) - self.sizes[t])[cell]
            place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            pairs.append(np.repeat(row, size) * len(self.ids) + self.members[t][np.repeat(start, size) + place])
        return np.divmod(np.unique(np.concatenate(pairs)), len(self.ids))

    def _dense(self, query: np.ndarray, own: np.ndarray, visits) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that may be among the best of each query, by products in single precision and a bound of their error."""
        met = None if visits is None else [self._met(t, len(own), *visit) for t, visit in enumerate(visits)]
        norm = np.linalg.norm(own, axis=1)
        asked = (own / norm[:, None]).astype(np.float32)
        border = np.full(len(own), -np.inf)
        kept = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0)]
        came: list[tuple[np.ndarray, ...]] = []
        start, width = 0, max(2048, self.enough)
        room = np.empty(len(own) * max(width, 16384), dtype=np.float32), np.empty(len(own) * max(width, 16384), dtype=bool)
        while start < len(self.ids):
            end = min(start + width, len(self.ids))
            # twice what the rounding of the components, the products and their sums can make
            slack = (own.shape[1] + 8) * (2.0**-23 * self.norms[start] + 2.0**-120)
            if (border > self.norms[start] + slack).all():
                break
            scores, over = (x[: len(own) * (end - start)].reshape(len(own), end - start) for x in room)
            np.matmul(asked, self.narrow[start:end].T, out=scores)
            fresh = np.flatnonzero(border == -np.inf)
            if len(fresh):
                part = scores[fresh]
                part[(query[fresh, None] == self.ids[start:end]) | ~self._all_met(met, fresh, start, end)] = -np.inf
                if part.shape[1] > self.enough:
                    last = part.shape[1] - self.enough
                    border[fresh] = np.partition(part, last, axis=1)[:, last] - slack
                scores[fresh] = part
            low = np.maximum(border - slack, np.finfo(np.float32).min).astype(np.float32)
            row, at = np.divmod(_set_flags(np.greater_equal(scores, low[:, None], out=over).ravel()), end - start)
            score = scores[row, at].astype(float)
            row, at, score = self._sharing(met, row, at + start, score)
            other = self.ids[at] != query[row]
            came.append((row[other], at[other], score[other] - slack, score[other] + slack))
            if sum(len(c[0]) for c in came) > 16 * len(own) or end == len(self.ids):
                kept = self._first([np.concatenate(c) for c in zip(kept, *came)], border)
                came = []
            start, width = end, min(2 * width, 16384)
        kept = self._first([np.concatenate(c) for c in zip(kept, *came)], border)
        return kept[0], kept[1]

    def _first(self, found: list[np.ndarray], border: np.ndarray) -> list[np.ndarray]:
        """Raise the ``border`` to what the best of each query reach at least; what may reach it is kept."""
        row, at, least, most = found
        order = np.lexsort((-least, row))
        place = np.arange(len(row)) - np.searchsorted(row[order], row[order])
        last = order[place == self.enough - 1]
        border[row[last]] = np.maximum(border[row[last]], least[last])
        keep = most >= border[row]
        return [c[keep] for c in found]

    def _met(self, t: int, queries: int, row: np.ndarray, cell: np.ndarray, _) -> tuple[np.ndarray, np.ndarray]:
        """Whether a query visits a cell, and the column of each vector's cell; cells that none visits are column 0."""
        used, column = np.unique(cell, return_inverse=True)
        columns = np.zeros(len(self.keys[t]), dtype=np.int32)
        columns[used] = np.arange(1, len(used) + 1)
        visited = np.zeros((queries, len(used) + 1), dtype=bool)
        visited[row, column + 1] = True
        return visited, columns[self.cells[t]]

    def _all_met(self, met, rows: np.ndarray, start: int, end: int) -> np.ndarray:
        if met is None:
            return np.ones((len(rows), end - start), dtype=bool)
        shares = np.zeros((len(rows), end - start), dtype=bool)
        for visited, column in met:
            shares |= np.take(visited[rows], column[start:end], axis=1)
        return shares

    def _sharing(self, met, row, at, score):
        """The pairs that share a cell in some table."""
        if met is not None and len(row):
            left = np.arange(len(row))
            for visited, column in met:
                left = left[~visited[row[left], column[at[left]]]]
            keep = np.ones(len(row), dtype=bool)
            keep[left] = False
            row, at, score = row[keep], at[keep], score[keep]
        return row, at, score


def _search(tables: Tables | None, most: int, exponent: int):
    """The best of each query among a block's vectors, which come before the queries."""
    a, b = _halves(-exponent)

    def work(batches):
        block, ids, vectors = None, [], []
        for batch in batches:
            asks = column(batch, "asks").to_numpy(zero_copy_only=False)
            first = int(np.searchsorted(asks, True))
            if first:
                held = _matrix(batch.slice(0, first)) * a * b
                narrow = held.astype(np.float32)
                vectors.append(narrow if (narrow == held).all() else held)
                ids.append(column(batch, "id").to_numpy()[:first])
            if first == batch.num_rows or block is None and not ids:
                continue
            if block is None:
                ids, held, vectors = np.concatenate(ids), np.concatenate(vectors), []
                block, held = Block(ids, held, tables, most), None
            rest = batch.slice(first)
            found = []
            for start in range(0, rest.num_rows, AT_ONCE):
                part = rest.slice(start, AT_ONCE)
                query = column(part, "id").to_numpy()
                row, vec, score = block.search(query, _matrix(part) * a * b)
                found.append((query, np.bincount(row, minlength=len(query)), vec, score))
            query, sizes, vec, score = map(np.concatenate, zip(*found))
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (vec, score)]
            yield pa.RecordBatch.from_arrays([pa.array(query), *lists], names=["query_id", "vec_ids", "scores"])

    return work


def _merge(most: int):
    """The best of each query over all blocks, from lists that come sorted by query_id."""

    def rows(query, vec, score) -> pa.RecordBatch:
        rank = (np.arange(len(query)) - np.searchsorted(query, query) + 1).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(query), pa.array(rank), pa.array(vec), pa.array(score)], names=["query_id", "rank", "vec_id", "score"])

    def work(batches):
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            vec, score = column(batch, "vec_ids"), column(batch, "scores")
            query = np.repeat(column(batch, "query_id").to_numpy(), np.diff(vec.offsets.to_numpy()))
            came = (query, vec.flatten().to_numpy(), score.flatten().to_numpy())
            kept = _best(*(map(np.concatenate, zip(kept, came)) if kept else came), most)
            # the last query may go on in the next batch
            end = int(np.searchsorted(kept[0], kept[0][-1])) if len(kept[0]) else 0
            if end:
                yield rows(*(c[:end] for c in kept))
                kept = tuple(c[end:] for c in kept)
        if kept and len(kept[0]):
            yield rows(*kept)

    return work


def _block_search(held: DataFrame, asked: DataFrame, blocks: int, tables: Tables | None, neighbours: int, exponent: int) -> DataFrame:
    """query_id, rank, vec_id, score of the scaled vectors; one task for each block of the vectors."""
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    dealt = held.withColumn("block", block).withColumn("asks", F.lit(False))
    probes = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("asks", F.lit(True))
    both = dealt.unionByName(probes).repartitionById(blocks, F.col("block")).drop("block").sortWithinPartitions("asks")
    lists = both.mapInArrow(_search(tables, neighbours, exponent), "query_id long, vec_ids array<long>, scores array<double>")
    lists = lists.repartition("query_id").sortWithinPartitions("query_id")
    return lists.mapInArrow(_merge(neighbours), "query_id long, rank int, vec_id long, score double")


def nearest(
    vectors: DataFrame, queries: DataFrame, neighbours: int = 20, vec_id: str = "vec_id", vector: str = "embedding", chunk: int = 4096, sample: int = 2000, **tables
) -> DataFrame:
    """The ``neighbours`` nearest found of each query: query_id, rank (from 1), vec_id, score.

    Nearness is the inner product of the vectors as given, in double precision; ties go to the smaller vec_id, and a row of the
    query's own id is no neighbour. ``queries`` has the columns of ``vectors``. ``sample`` bounds the vectors, in the order of
    a hash of their id, on which the number of probes is fitted. Blocks have at most ``BLOCK`` components, and as long as there
    are fewer blocks than cores, about ``chunk`` vectors.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without an id or
    vectors of another length than most. Rows of one id with the same vector count once, with different vectors each for
    itself, the best score counting. Only where there are fewer candidates in all are there fewer rows; an empty table gives none. Other columns are left out.
    """
    spark = vectors.sparkSession

    # a vector travels as it is given: single precision is half as large
    single = all(isinstance(f.schema[vector].dataType.elementType, FloatType) for f in (vectors, queries))

    def plain(frame: DataFrame) -> DataFrame:
        v = F.col(vector).cast("array<float>" if single else "array<double>")
        return frame.where(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), v.alias("v"))

    empty = "query_id long, rank int, vec_id long, score double"
    held = plain(vectors)
    sizes = held.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest"))
    most = sizes.orderBy(F.desc("rows"), F.desc("n")).first()
    if most is None:
        return spark.createDataFrame([], empty)
    # by a power of two, which loses nothing, so that the largest component is near 1 and no sum overflows
    exponent = math.frexp(most.largest)[1]

    def written(frame: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    held = _indexed(written(held.where(F.size("v") == most.n), "vectors"), neighbours, written)
    asked = written(plain(queries).where(F.size("v") == most.n).distinct(), "queries")
    square, count = _scaled(held, exponent).agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)), F.count("*")).first()
    fitted = Tables(float(square) ** 0.5, most.n, **tables)
    picked = _scaled(held.orderBy(F.md5(F.col("id").cast("string")), "id").limit(sample), exponent).collect()
    if "probes" not in tables:
        fitted = fit_probes(fitted, np.array([r.v for r in picked], dtype=np.float64), neighbours)

    blocks = max(-(-count * most.n // BLOCK), min(-(-count // chunk), spark.sparkContext.defaultParallelism))
    found = _block_search(held, asked, blocks, fitted, neighbours, exponent)
    best = written(_as_given(found, asked, held, exponent, written), "nearest")

    # a query's candidates are all ids but its own; whoever got fewer than there are is compared with all vectors
    ids = held.select(F.col("id").alias("query_id")).distinct()
    total = ids.count()
    own = asked.select(F.col("id").alias("query_id")).distinct().join(ids.withColumn("own", F.lit(1)), "query_id", "left")
    need = F.least(F.lit(neighbours), F.lit(total) - F.coalesce("own", F.lit(0)))
    got = best.groupBy("query_id").agg(F.count("*").alias("n"))
    short = written(own.join(got, "query_id", "left").where(F.coalesce("n", F.lit(0)) < need).select("query_id"), "short")
    if short.isEmpty():
        return best
    again = asked.join(short, F.col("id") == F.col("query_id"), "left_semi")
    found = _block_search(held, again, blocks, None, neighbours, exponent)
    return best.join(short, "query_id", "left_anti").unionByName(_as_given(found, again, held, exponent, written))


def _indexed(held: DataFrame, neighbours: int, written: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The vectors without repeated rows, and of equal vectors those of the smallest ids. Where hashes show neither, nothing is moved."""
    marks = held.groupBy(F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), "v").alias("b"), "id").agg(F.count("*").alias("rows"))
    alike = marks.groupBy("a", "b").agg(F.max("rows").alias("rows"), F.count("*").alias("ids"))
    rows, ids = alike.agg(F.max("rows"), F.max("ids")).first()
    kept = held.distinct() if rows > 1 else held
    if ids > neighbours + 1:
        # the hash first: it is sorted faster than vectors
        copies = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id")
        kept = kept.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= neighbours + 1).drop("_copy")
    return held if kept is held else written(kept, "indexed")


def _halves(exponent: int) -> tuple[float, float]:
    """Two powers of two whose product is 2 ** exponent; one alone may be too large or too small for a double."""
    return math.ldexp(1.0, exponent // 2), math.ldexp(1.0, exponent - exponent // 2)


def _scaled(rows: DataFrame, exponent: int) -> DataFrame:
    a, b = _halves(-exponent)
    return rows.withColumn("v", F.transform("v", lambda x: x.cast("double") * a * b))


def _as_given(found: DataFrame, asked: DataFrame, held: DataFrame, exponent: int, written: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """What was found, with the scores of the vectors as they were given.

    Scaling by a power of two changes no digit of a score. Only where it could overflow, and for ids of several vectors, of
    which the best pair counts, are the vectors fetched again.
    """
    a, b = _halves(exponent)
    if abs(exponent) <= EXACT_EXPONENT:
        several = [frame.groupBy("id").count().where("count > 1").select("id") for frame in (asked, held)]
        if all(s.isEmpty() for s in several):
            return found.withColumn("score", F.col("score") * a * b * a * b)
    best = written(found, "found").drop("score")
    best = best.join(asked.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id")
    best = best.join(held.select(F.col("id").alias("vec_id"), "v"), "vec_id")
    product = F.aggregate(F.zip_with("q", "v", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    best = best.select("query_id", "rank", "vec_id", product.alias("score"))
    return best.groupBy("query_id", "rank", "vec_id").agg(F.max("score").alias("score"))
