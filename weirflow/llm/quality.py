"""Quality from random-indexing word vectors and a small network.

Words and runs of marks are tokens; beside its hash, a token has a shape (capitals, digits, length). Every bucket of tokens
has a sparse random index vector, and its context vector is the sum of the index vectors found next to it in all documents,
labelled or not: each task adds up its own part of the corpus, and the parts are added by bucket. A document is the mean of its tokens' context vectors, with the concentration of its index vectors (how much it
repeats itself) and its length. A network of two layers turns this into a probability, calibrated by a temperature on
documents that the network was not trained on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from weirflow.llm.logistic import labelled_sample, sigmoid
from weirflow.llm.texts import IS_SPACE, byte_runs, column, pieces, utf8

BUCKETS, SHAPES, DIMENSIONS, NONZERO, HIDDEN = 1 << 14, 128, 48, 6, 24
#: Bytes of text at once: their vectors stay in a processor's cache.
PIECE = 250_000

_CODE = np.arange(256)
IS_UPPER = (_CODE >= 65) & (_CODE <= 90)
IS_DIGIT = (_CODE >= 48) & (_CODE <= 57)
IS_WORD = IS_UPPER | IS_DIGIT | ((_CODE >= 97) & (_CODE <= 122)) | (_CODE >= 128)


def index_vectors(seed: int = 7) -> np.ndarray:
    """A sparse vector of ones and minus ones for each bucket, always the same."""
    rng = np.random.default_rng(seed)
    out = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
    places = rng.integers(0, DIMENSIONS, (BUCKETS, NONZERO))
    signs = rng.choice(np.array([-1.0, 1.0], dtype=np.float32), (BUCKETS, NONZERO))
    np.put_along_axis(out, places, signs, axis=1)
    return out


class Tokens:
    """The tokens of a piece: a bucket by hash and one by shape, and where each row's tokens start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        kind = np.where(IS_SPACE[data], 0, np.where(IS_WORD[data], 1, 2)).astype(np.int8)
        first = np.ones(len(data), dtype=bool)
        first[1:] = kind[1:] != kind[:-1]
        first[offsets[:-1][offsets[:-1] < len(data)]] = True
        start = np.flatnonzero(first)
        end = np.append(start[1:], len(data))
        solid = kind[start] > 0 if len(start) else first[:0]
        start, end = start[solid], end[solid]
        self.at = np.searchsorted(start, offsets)
        size = end - start
        word = kind[start] == 1
        upper, digit = (np.concatenate(([0], np.cumsum(is_it[data]))) for is_it in (IS_UPPER, IS_DIGIT))
        uppers = upper[end] - upper[start]
        shape = np.minimum(np.searchsorted([1, 3, 6, 10], size), 4) * 16
        shape += word * 8 + (digit[end] > digit[start]) * 4 + (IS_UPPER[data[start]] if len(start) else word) * 2 + ((uppers == size) & word) * 1
        self.shape = BUCKETS - SHAPES + shape
        self.token = (byte_runs(data).hash(start, end) % np.uint64(BUCKETS - SHAPES)).astype(np.int64)


def _mean(table: np.ndarray, tokens: Tokens) -> np.ndarray:
    """The mean of the rows' tokens' vectors, shapes included; zeros for rows without tokens."""
    sizes = np.diff(tokens.at)
    out = np.zeros((len(sizes), table.shape[1]), dtype=np.float64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        out[filled] = np.add.reduceat(table[tokens.token], tokens.at[:-1][filled], axis=0)
        # few shapes: count them by row, and add their vectors by the counts, one by one, so that a row's sum is its own
        shape = np.repeat(np.arange(len(sizes)) * SHAPES, sizes) + (tokens.shape - (BUCKETS - SHAPES))
        counts = np.bincount(shape, minlength=len(sizes) * SHAPES).reshape(len(sizes), SHAPES)
        for i in np.flatnonzero(counts.any(axis=0)):
            out += counts[:, i, None] * table[BUCKETS - SHAPES + i].astype(np.float64)
        out[filled] /= sizes[filled, None]
    return out


@dataclass(frozen=True)
class Model:
    context: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float

    def features(self, data: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> np.ndarray:
        tokens = Tokens(data, offsets)
        meant = _mean(self.context, tokens)
        spread = np.square(_mean(index, tokens)).sum(axis=1)
        sizes = np.diff(tokens.at)
        return np.column_stack((meant, np.log1p(spread), np.log1p(sizes), np.log1p(spread * sizes)))

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        # matrix products would make a row's last digits depend on how many rows come with it
        hidden = np.tanh(np.add.reduce(((x - self.center) / self.scale)[:, :, None] * w1, axis=1) + b1)
        return np.add.reduce(hidden * w2, axis=1) + b2

    def scores(self, data: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(self.features(data, offsets, index)) / self.temperature)


def add_contexts(out: np.ndarray, tokens: Tokens, index: np.ndarray, reach: int = 2, block: int = 1 << 13) -> None:
    """Add to each bucket, whole numbers, the index vectors of the tokens and shapes up to ``reach`` places from it in its row."""
    sizes = np.diff(tokens.at)
    row = np.repeat(np.arange(len(sizes)), sizes)
    # rows are set apart by ``reach`` empty places, whose bucket comes last and has no vector
    place = np.arange(len(row)) + reach * (row + 1)
    token = np.full(len(row) + reach * (len(sizes) + 1), BUCKETS, dtype=np.int16)
    shape = token.copy()
    token[place], shape[place] = tokens.token, tokens.shape
    index = np.concatenate((index, np.zeros((1, DIMENSIONS), dtype=index.dtype)))
    for start in range(reach, len(token) - reach, block):
        end = min(len(token) - reach, start + block)
        vectors = index[token[start - reach : end + reach]] + index[shape[start - reach : end + reach]]
        near = sum(vectors[step : step + end - start] for step in range(2 * reach + 1) if step != reach)
        for buckets in (token[start:end], shape[start:end]):
            order = np.argsort(buckets, kind="stable")
            found = buckets[order]
            first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
            # a block's sums are far below 2**24, so they are exact
            sums = np.add.reduceat(near[order], first, axis=0).astype(np.int64)
            real = found[first] < BUCKETS
            out[found[first][real]] += sums[real]


def contexts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The context sums of all buckets over all documents, the same for any partitioning. Null and empty texts add nothing.

    A task sends at most a row for each bucket, so what is shuffled has a bound for each task; the result has a fixed size.
    """
    names = [f"d{i}" for i in range(DIMENSIONS)]

    def work(batches):
        index, out = index_vectors(), np.zeros((BUCKETS, DIMENSIONS), dtype=np.int64)
        for piece in pieces(batches, limit=PIECE):
            add_contexts(out, Tokens(*utf8(column(piece, "text"))), index)
        met = np.flatnonzero(out.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(met), *(pa.array(out[met, i]) for i in range(DIMENSIONS))], names=["bucket", *names])

    parts = docs.select(F.col(text).alias("text")).mapInArrow(work, ", ".join(f"{n} long" for n in ["bucket", *names]))
    total = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    out = np.zeros((BUCKETS, DIMENSIONS))
    out[total["bucket"].to_numpy()] = np.column_stack([total[n].to_numpy() for n in names])
    return out


def _train_network(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int, decay: float, seed: int) -> tuple[np.ndarray, ...]:
    """Two layers by Adam on the weighted cross entropy of all rows at once."""
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    weight = weight / weight.sum()
    for t in range(1, rounds + 1):
        w1, b1, w2, b2 = layers
        h = np.tanh(x @ w1 + b1)
        error = weight * (sigmoid(h @ w2 + b2) - y)
        back = np.outer(error, w2) * (1 - h * h)
        steps = [x.T @ back + decay * w1, back.sum(axis=0), h.T @ error + decay * w2, np.array([error.sum()])]
        for p, g, m, v in zip(layers, steps, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return tuple(layers)


def _temperature(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The temperature with the smallest weighted cross entropy."""
    choices = np.geomspace(0.25, 8, 61)
    loss = [-(weight * np.log(np.clip(np.where(y > 0, sigmoid(logits / t), sigmoid(-logits / t)), 1e-12, 1))).sum() for t in choices]
    return float(choices[int(np.argmin(loss))])


def _pieces(sample: list[tuple[bytes, int]], limit: int = 1_000_000):
    """The sample's bytes and offsets, about ``limit`` bytes at a time."""
    held, size = [], 0
    for i, (text, _) in enumerate(sample):
        held.append(text)
        size += len(text)
        if size >= limit or i == len(sample) - 1:
            yield np.frombuffer(b"".join(held), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in held])))
            held, size = [], 0


def train(sample: list[tuple[bytes, int]], totals: dict[int, int], context: np.ndarray, rounds: int = 300, decay: float = 1e-3) -> Model:
    """A model from (text, label) pairs and context sums; ``totals`` are the numbers of labels of each class that the sample stands for.

    Without both labels every score is the share of label 1 (a half without any).
    """
    index = index_vectors()
    y = np.array([label for _, label in sample], dtype=float)
    width = DIMENSIONS + 3
    if len(set(y)) < 2:
        logit = 0.0 if not len(y) else (6.0 if y[0] else -6.0)
        flat = (np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.array([logit]))
        return Model(np.zeros((BUCKETS, DIMENSIONS), np.float32), np.zeros(width), np.ones(width), flat, 1.0)
    context = (context / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    bare = Model(context, np.zeros(width), np.ones(width), (), 1.0)
    x = np.concatenate([bare.features(*piece, index) for piece in _pieces(sample)])
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    weight = np.where(y > 0, totals[1] / (y > 0).sum(), totals[0] / (y == 0).sum())
    held = np.arange(len(y)) % 5 == 0
    layers = _train_network((x[~held] - center) / scale, y[~held], weight[~held], rounds, decay, 11)
    model = Model(context, center, scale, layers, 1.0)
    return Model(context, center, scale, layers, _temperature(model.logits(x[held]), y[held], weight[held]))


def fit(docs: DataFrame, labels: DataFrame, use: Column, label: str = "quality", doc_id: str = "doc_id", text: str = "text", per_class: int = 1500, max_bytes: int = 6_000_000) -> Model:
    """A model: word vectors from all documents, the network from at most ``per_class`` labelled ones of each class (see ``labelled_sample``)."""
    return train(*labelled_sample(docs, labels, label, doc_id, text, use, per_class, max_bytes), contexts(docs, text))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``row`` (the row itself, as a struct) and score, the probability of good quality.

    Every token of the whole text counts. Null, empty and blank texts have no tokens and get the score of a document of
    length 0. Rows are scored each for itself, so repeated rows, null or equal ids and extra columns of any name don't matter.
    An empty table gives no rows.
    """

    def work(batches):
        index = index_vectors()
        for piece in pieces(batches, limit=PIECE):
            scores = model.scores(*utf8(column(piece, "text")), index)
            yield pa.RecordBatch.from_arrays([column(piece, "row"), pa.array(scores)], names=["row", "score"])

    rows = docs.select(F.col(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.mapInArrow(work, StructType([StructField("row", docs.schema), *StructType.fromDDL("score double")]))
