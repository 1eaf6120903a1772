"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic text and one on ordinary text. A window of words that is shorter when
compressed with the toxic dictionary than with the ordinary one speaks for toxicity; a document's count and share of windows
whose difference reaches each of some thresholds are turned into a probability by a calibration on labelled documents.

A dictionary is raw content: words that set its class apart from the other (by the likelihood ratio of the documents that
hold them), then a part common to both, the most frequent words, so that the two differ in nothing else. Copies and
near copies in the sample are left out first, so that the words of a much copied document don't pass for those of its class.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from weirflow.llm.logistic import fit as fit_logistic
from weirflow.llm.logistic import labelled_sample, sigmoid
from weirflow.llm.texts import column, pieces

LEVEL, WINDOW, STEP, THRESHOLDS = 6, 8, 4, (2, 3, 4, 5, 6)


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    carrier: bytes
    weights: tuple[float, ...]
    level: int = LEVEL
    window: int = WINDOW

    def compressors(self):
        def make(content: bytes):
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(level=self.level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)

        return make(self.ordinary), make(self.toxic)


def _evidence(text: bytes, model: Model, ordinary, toxic, known: dict[bytes, int]) -> np.ndarray:
    """For each threshold the logarithm of the number of windows that reach it and their share, and the logarithm of the number of words."""
    words = text.lower().split()
    counts = Counter()
    size = model.window
    for i in range(0, max(1, len(words) - size + STEP), STEP):
        window = b" ".join(words[i : i + size])
        gain = known.get(window)
        if gain is None:
            body = model.carrier + window + b" "
            gain = known[window] = len(ordinary.compress(body)) - len(toxic.compress(body))
        counts[gain] += 1
    reach = np.array([sum(n for gain, n in counts.items() if gain >= t) for t in THRESHOLDS])
    return np.array([*np.log1p(reach), *(10 * reach / counts.total()), np.log1p(len(words) / size)])


def distinct(sample: list[tuple[bytes, int]], grams: int = 5, share: float = 0.3) -> list[tuple[bytes, int]]:
    """The sample without texts of which more than ``share`` of the word n-grams stand in texts before."""
    seen: set[int] = set()
    out = []
    for text, y in sample:
        words = text.lower().split()
        here = {zlib.crc32(b" ".join(words[i : i + grams])) for i in range(max(1, len(words) - grams + 1))}
        if len(here & seen) <= share * len(here):
            out.append((text, y))
        seen |= here
    return out


def _content(chosen: list[bytes], common: list[bytes]) -> bytes:
    return b" ".join([*chosen, *common]) + b" "


def _ratio(a: np.ndarray, b: np.ndarray, n: int, m: int) -> np.ndarray:
    """Likelihood ratio of a in n against b in m, with the sign of the difference."""

    def fitted(k, n, p):
        p = np.clip(p, 1e-12, 1 - 1e-12)
        return k * np.log(p) + (n - k) * np.log(1 - p)

    both = (a + b) / (n + m)
    return 2 * (fitted(a, n, a / n) + fitted(b, m, b / m) - fitted(a, n, both) - fitted(b, m, both)) * np.sign(a / n - b / m)


def train(sample: list[tuple[bytes, int]], totals: dict[int, int], common_words: int = 1500, least_ratio: float = 25.0) -> Model:
    """A model from (text, label) pairs; ``totals`` are the numbers of labels of each class that the sample stands for.

    Without both labels every score is the share of label 1, or a half.
    """
    sample = distinct(sample)
    holding = (Counter(), Counter())
    size = [0, 0]
    for text, y in sample:
        holding[y].update(set(text.lower().split()))
        size[y] += 1
    if not all(size):
        share = (sum(size) and size[1] / sum(size)) or (0.0 if sum(size) else 0.5)
        logit = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return Model(b" ", b" ", b"", (*[0.0] * (2 * len(THRESHOLDS) + 1), logit))
    words = sorted(set(holding[0]) | set(holding[1]))
    counts = [np.array([h[w] for w in words], dtype=float) for h in holding]
    ratio = _ratio(counts[1], counts[0], size[1], size[0])
    chosen = [words[i] for i in np.argsort(-ratio, kind="stable") if ratio[i] >= least_ratio]
    others = [words[i] for i in np.argsort(ratio, kind="stable") if ratio[i] < least_ratio]
    room, plain = sum(len(w) + 1 for w in chosen), []
    for w in others:
        if room <= 0:
            break
        plain.append(w)
        room -= len(w) + 1
    usual = [i for i in np.argsort(-counts[0], kind="stable") if counts[0][i] > 0 and ratio[i] < least_ratio]
    common = [words[i] for i in usual[:common_words]][::-1]
    carrier = b" ".join(common)[:40] + b" "
    model = Model(_content(chosen, common), _content(plain, common), carrier, ())
    ordinary, toxic = model.compressors()
    known: dict[bytes, int] = {}
    x = np.array([_evidence(text, model, ordinary, toxic, known) for text, _ in sample])
    y = np.array([label for _, label in sample], dtype=float)
    # half way, in logarithms, between the sample's classes and all labels': missing toxic text costs more than a false alarm
    each = np.sqrt(np.where(y > 0, totals[1] / size[1], totals[0] / size[0]))
    weights = fit_logistic(x, y, each * len(y) / each.sum())
    return Model(model.toxic, model.ordinary, carrier, tuple(weights))


def fit(docs: DataFrame, labels: DataFrame, use: Column, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", per_class: int = 1500, max_bytes: int = 6_000_000) -> Model:
    """A model from at most ``per_class`` labelled documents of each class, of ``max_bytes`` bytes in all (see ``labelled_sample``)."""
    return train(*labelled_sample(docs, labels, label, doc_id, text, use, per_class, max_bytes))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``row`` (the row itself, as a struct) and score, the probability that it is toxic.

    Every window of the whole text counts; a word is in two windows. Null, empty and blank texts have no windows and get the
    score of a text without evidence. Rows are scored each for itself, so repeated rows, null or equal ids and extra columns of any
    name don't matter. An empty table gives no rows.
    """

    def work(batches):
        ordinary, toxic = model.compressors()
        weights = np.array(model.weights)
        for batch in batches:
            for piece in pieces([batch]):
                known: dict[bytes, int] = {}
                x = [_evidence(t or b"", model, ordinary, toxic, known) for t in column(piece, "text").cast(pa.large_binary()).to_pylist()]
                scores = sigmoid(np.array(x) @ weights[:-1] + weights[-1])
                yield pa.RecordBatch.from_arrays([column(piece, "row"), pa.array(scores)], names=["row", "score"])

    rows = docs.select(F.col(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.mapInArrow(work, StructType([StructField("row", docs.schema), *StructType.fromDDL("score double")]))
