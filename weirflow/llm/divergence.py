"""How far the sources of a language use its words differently: a vocabulary in minimal acyclic transducers, and recounts.

The terms that enough documents of a language hold are its vocabulary. Sorted, they are cut into ranges of about
``SHARD_TERMS`` terms, and a range becomes one transducer: states with equal futures are one state, and each arc carries how
many terms precede those behind it, so that reading a term adds up its place in the order. The texts are then read again:
each task folds its terms by source and sends each fold to the range it falls in, where it streams through the transducer;
what is not in the vocabulary falls out. Range and place make a term's ordinal in its language, in the order of its bytes, so
ordinals break ties; the terms themselves come back in at the end, for the rows that are reported.

No transducer, source or term meets more than its own range: a frequent term costs its range one row for each fold.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.texts import column, pieces
from weirflow.session import scratch_path

#: Terms of one transducer, terms that a task folds before it sends them, folded terms that one transducer reads, and terms
#: of one block of sums.
SHARD_TERMS, FOLDS, FOLD_TERMS, BLOCK_TERMS = 100_000, 200_000, 1_000_000, 4096
SCALE = 1_000_000_000
#: Characters that belong to no term become blanks, A to Z become a to z; all bytes of other letters stay.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split()


class Transducer:
    """A minimal acyclic transducer of sorted terms; reading a term gives its place among them."""

    def __init__(self, sorted_terms: Iterable[bytes]):
        register: dict[tuple, int] = {}
        self.arcs: list[dict[int, tuple[int, int]]] = []
        self.size: list[int] = []
        self.final: list[bool] = []
        # the states of the last term's path: its arcs so far and whether a term ends there
        path: list[list] = [[[], False]]
        before = b""

        def settle(depth: int) -> None:
            """Settle the states deeper than ``depth``: each becomes the registered one of the same future."""
            while len(path) > depth + 1:
                arcs, final = path.pop()
                path[-1][0][-1][1] = self._state(register, arcs, final)

        for term in sorted_terms:
            if term == before:
                path[-1][1] = True
                continue
            shared = next((i for i, (a, b) in enumerate(zip(before, term)) if a != b), min(len(before), len(term)))
            settle(shared)
            for byte in term[shared:]:
                path[-1][0].append([byte, -1])
                path.append([[], False])
            path[-1][1] = True
            before = term
        settle(0)
        self.root = self._state(register, *path[0])

    def _state(self, register: dict[tuple, int], arcs: list, final: bool) -> int:
        future = (final, *map(tuple, arcs))
        if future not in register:
            register[future] = len(self.arcs)
            found, n = {}, int(final)
            for byte, state in arcs:
                found[byte] = (state, n)
                n += self.size[state]
            self.arcs.append(found)
            self.final.append(final)
            self.size.append(n)
        return register[future]

    def place(self, term: bytes) -> int:
        """The place of a term in the order, -1 if it is none of the terms."""
        state, place, arcs = self.root, 0, self.arcs
        for byte in term:
            arc = arcs[state].get(byte)
            if arc is None:
                return -1
            state = arc[0]
            place += arc[1]
        return place if self.final[state] else -1

    def terms(self) -> Iterator[bytes]:
        """All terms in order."""
        stack = [(self.root, b"")]
        while stack:
            state, term = stack.pop()
            if self.final[state]:
                yield term
            stack.extend((to, term + bytes([byte])) for byte, (to, _) in reversed(self.arcs[state].items()))


class Places(dict):
    """The places of terms, each read through the transducer once."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.read = transducer.place

    def __missing__(self, term: bytes) -> int:
        self[term] = found = self.read(term)
        return found


def _written(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _document_counts(batches):
    """(lang, term, n): in how many documents of a task a term stands, folded until ``FOLDS`` terms are held."""
    held: dict[str, Counter] = defaultdict(Counter)

    def rows():
        found = [(lang, t, n) for lang, counts in held.items() for t, n in counts.items()]
        held.clear()
        columns = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.binary(), pa.int64()))], names=["lang", "term", "n"])

    for piece in pieces(batches):
        for lang, text in zip(column(piece, "lang").to_pylist(), column(piece, "text").to_pylist()):
            held[lang].update(set(terms(text)))
            if sum(map(len, held.values())) >= FOLDS:
                yield rows()
    yield rows()


def _folds(bounds: list[tuple[str, bytes]], shards: list[int]):
    """(shard, lang, source, size, terms, counts): a task's terms, folded by source and cut by the ranges they fall in.

    The terms of a fold travel as one text with blanks between them, the counts as one run of whole numbers.
    """

    def work(batches):
        held: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def rows():
            parts = defaultdict(lambda: ([], []))
            for (lang, source), counts in held.items():
                for term, n in counts.items():
                    # what precedes the first range cannot be in the vocabulary
                    at = bisect.bisect_right(bounds, (lang, term)) - 1
                    if at >= 0:
                        listed = parts[shards[at], lang, source]
                        listed[0].append(term)
                        listed[1].append(n)
            held.clear()
            packed = [(*key, len(n), b" ".join(listed), np.array(n, dtype=np.int64).tobytes()) for key, (listed, n) in parts.items()]
            columns = zip(*packed) if packed else ((),) * 6
            types = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["shard", "lang", "source", "size", "terms", "counts"])

        for piece in pieces(batches):
            for lang, source, text in zip(*(column(piece, c).to_pylist() for c in ("lang", "source", "text"))):
                held[lang, source].update(terms(text))
                if sum(map(len, held.values())) >= FOLDS:
                    yield rows()
        yield rows()

    return work


def _recount(key: tuple, known: pd.DataFrame, folds: pd.DataFrame) -> pd.DataFrame:
    """Stream folds of one range and language through its transducer: (lang, source, shard, place, n)."""
    shard, lang, _ = key
    found = []
    if len(known):
        # at most fold_terms of them
        place = Places(Transducer(sorted(known["term"]))).__getitem__
        for source, part in folds.groupby("source"):
            n = np.zeros(len(known), dtype=np.int64)
            for listed, counts in zip(part["terms"], part["counts"]):
                places = np.fromiter(map(place, listed.split(b" ")), dtype=np.int64)
                known_ones = places >= 0
                # a fold holds a term once
                n[places[known_ones]] += np.frombuffer(counts, dtype=np.int64)[known_ones]
            at = np.flatnonzero(n)
            found.append(pd.DataFrame({"lang": lang, "source": source, "shard": shard, "place": at, "n": n[at]}))
    return pd.concat(found) if found else pd.DataFrame(columns=["lang", "source", "shard", "place", "n"])


def rate(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE x (count + 1) / total) in whole numbers, by long division with three digits at a time."""
    whole, rest = np.divmod(count + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _block(top: int):
    """One block's part of the distances between every two sources, and each source's ``top`` terms of the block."""

    def work(key: tuple, counts: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        lang, shard, _ = key
        names = groups["source"].tolist()
        places, at = np.unique(counts["place"].to_numpy(), return_inverse=True)
        n = np.zeros((len(names), len(places)), dtype=np.int64)
        n[pd.Index(names).get_indexer(counts["source"]), at] = counts["n"]
        p = rate(n, groups["total"].to_numpy()[:, None])
        common = rate(n.sum(axis=0), groups["lang_total"].to_numpy()[:1])
        found = []
        for i, source in enumerate(names):
            for item, value in zip(names, distance(p[i], p).sum(axis=1)):
                if item != source:
                    found.append((lang, source, item, None, None, int(value)))
            own = np.flatnonzero((n[i] > 0) & (p[i] > common))
            values = distance(p[i][own], common[own])
            for j in np.lexsort((places[own], -values))[:top]:
                found.append((lang, source, None, shard, int(places[own[j]]), int(values[j])))
        return pd.DataFrame(found, columns=["lang", "source", "item", "shard", "place", "value"]).astype({"shard": "Int32", "place": "Int64"})

    return work


def divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = 3,
    top: int = 200,
    shard_terms: int = SHARD_TERMS,
    fold_terms: int = FOLD_TERMS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every source of every language, ranked by ``value``, then by item.

    A term is a run of ASCII letters and characters outside ASCII, with A-Z in lower case. Terms in ``min_docs`` rows of a
    language or more are kept. A source of a language uses a kept term at the rate 1 + floor(10^9 (count + 1) / (N + V)): N
    occurrences of kept terms, V kept terms. Two rates p and q differ by floor((p - q)^2 / q). Part ``pair`` holds every
    other source of the language, with the sum over all kept terms, q being the other's rate; part ``term`` the ``top``
    terms that the source has and uses above the rate of its language.

    Null texts, languages and sources are empty ones. Every row counts as a document, equal rows too. A source without terms
    has the rate of no occurrences; in a language without kept terms all distances are 0. An empty table gives no rows. Columns
    of any name may stand in ``docs``. Whole numbers are exact up to 9 x 10^15 terms and 10^9 kept terms a language.
    """
    names = ((lang, "lang"), (source, "source"), (text, "text"))
    slim = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in names])
    seen = slim.select("lang", "text").mapInArrow(_document_counts, "lang string, term binary, n long")
    kept = seen.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")
    kept = _written(kept, "vocabulary")
    # a given number of ranges is not changed later, so the numbers of the ranges are in order
    ranges = kept.repartitionByRange(max(1, -(-kept.count() // shard_terms)), "lang", "term")
    ranges = _written(ranges.withColumn("shard", F.spark_partition_id()), "vocabulary-ranges")
    # one row for each range; strings compare by code points here, which is the order of their bytes
    firsts = ranges.groupBy("shard").agg(F.min(F.struct("lang", "term")).alias("first")).orderBy("shard").collect()
    cut = _folds([(r.first.lang, bytes(r.first.term)) for r in firsts], [r.shard for r in firsts])
    folds = slim.mapInArrow(cut, "shard int, lang string, source string, size long, terms binary, counts binary")
    folds = _written(folds.withColumn("id", F.monotonically_increasing_id()), "folds")
    # a range that gets more than fold_terms is read by several transducers of the same terms
    parts = F.ceil(F.sum("size") / fold_terms).cast("int").alias("parts")
    parts = _written(folds.groupBy("shard", "lang").agg(parts), "fold-parts")
    dealt = folds.join(parts, ["shard", "lang"]).withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    known = ranges.join(parts, ["shard", "lang"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    key = ["shard", "lang", "part"]
    recounted = known.select(*key, "term").groupBy(*key).cogroup(dealt.select(*key, "source", "terms", "counts").groupBy(*key))
    recounted = recounted.applyInPandas(_recount, "lang string, source string, shard int, place long, n long")
    counts = _written(recounted.groupBy("lang", "source", "shard", "place").agg(F.sum("n").alias("n")), "recounts")

    found = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    size = kept.groupBy("lang").agg(F.count("*").alias("v"))
    groups = slim.select("lang", "source").distinct().join(found, ["lang", "source"], "left").join(size, "lang", "left").na.fill(0, ["n", "v"])
    total = F.sum("n").over(Window.partitionBy("lang")) + F.col("v")
    groups = _written(groups.select("lang", "source", (F.col("n") + F.col("v")).alias("total"), total.alias("lang_total")), "sources")

    key = ["lang", "shard", "block"]
    blocks = counts.withColumn("block", F.expr(f"place div {block_terms}"))
    meets = _written(blocks.select(*key).distinct().join(groups, "lang"), "block-sources")
    sums = blocks.groupBy(*key).cogroup(meets.groupBy(*key)).applyInPandas(_block(top), "lang string, source string, item string, shard int, place long, value long")
    sums = _written(sums, "block-sums")

    values = sums.where("item IS NOT NULL").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = pairs.join(values, ["lang", "source", "item"], "left").na.fill(0, ["value"])
    group = Window.partitionBy("lang", "source")
    pairs = pairs.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item")))

    first = sums.where("item IS NULL").withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "shard", "place")))
    places = ranges.withColumn("place", F.row_number().over(Window.partitionBy("shard", "lang").orderBy("term")).cast("long") - 1)
    named = first.where(F.col("rank") <= top).drop("item").join(places, ["lang", "shard", "place"])
    named = named.withColumn("item", F.col("term").cast("string"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(named.withColumn("part", F.lit("term")).select(columns))
