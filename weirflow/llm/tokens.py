"""Exact token counts of every prefix of a text, for a byte-pair model of the sentencepiece library.

The encoding of a text has this property: any two neighbouring tokens are what the merges give for their two strings put
together, and any row of tokens for which this holds is an encoding. So the last token of a prefix follows from those of the
shorter prefixes: it is the one token that ends there and may follow the last token of the prefix before it. One pass over
the positions thus gives the token count of every prefix. A count can fall as a prefix grows, so the changes are stored, one
signed byte for each code point; sums over them answer how many tokens a prefix has and where a budget is used up.

No token holds a blank behind another character, so a text falls into words with the blanks in front of them, whose counts
do not touch each other; the changes of short words are kept for the next text.
"""

from __future__ import annotations

import functools
import gc
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from weirflow.llm.texts import column, pieces

#: Fixed value: the character that stands for a blank inside the model.
BLANK = "▁"
#: Words of at most this length are kept, and at most so many of them; those met lately stay.
WORD_CHARS, KEPT = 64, 500_000
#: States that are kept; then they are worked out anew.
STATES = 200_000


#: What a beginning of a token can be.
TOKEN, LONGER = 1, 2


class State:
    """What the prefixes read so far leave to be known: for each place where a token has begun that may go on, the token
    before it, its characters, and how far the count there is behind."""

    __slots__ = ("open", "next")

    def __init__(self, open: tuple[tuple[str, str, int], ...]):
        self.open, self.next = open, {}


class Words(dict):
    """The changes of the token count over the prefixes of words; missing ones are worked out, and those not met for long go."""

    def __init__(self, steps):
        super().__init__()
        self.steps, self.older = steps, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.steps(word)
        if len(word) <= WORD_CHARS:
            if len(self) >= KEPT // 2:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


class PrefixCounts:
    """Token counts of the prefixes of texts, as the model's library would give them for each prefix alone."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=model)
        plain = [i for i in range(library.get_piece_size()) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))]
        self.score = {library.id_to_piece(i): library.get_score(i) for i in plain}
        if library.normalize("ﬁ a") != f"{BLANK}ﬁ{BLANK}a" or any(BLANK in p.lstrip(BLANK) for p in self.score):
            raise ValueError("the model must keep characters as they are, put a blank in front and have none inside its tokens")
        # every beginning of a token: whether it is one, and whether there is a longer one
        self.begins = {p[:i]: LONGER for p in self.score for i in range(len(p))}
        for p in self.score:
            self.begins[p] = self.begins.get(p, 0) | TOKEN
        self.states: dict[tuple, State] = {}
        self.start = State((("", "", 0),))
        # a character that no token holds stands alone: the line end, if it is one, and one to read tokens behind
        held = set("".join(self.score))
        alone = "" if "\n" in held else "\n"
        self.split = re.compile(f"{BLANK}*[^{BLANK}{alone}]+|{BLANK}+" + (f"|{alone}+" if alone else "")).findall
        self.wall = next(c for c in map(chr, range(10, 0x10000)) if c not in held)
        self.behind = len(library.encode(self.wall))
        self.follows = functools.lru_cache(1_000_000)(self._follows)
        self.words = Words(self.steps)

    def _follows(self, before: str, token: str) -> bool:
        """Whether the library leaves the two as they are; a character without a token is as good as none."""
        known = [before, token] if before in self.score else [token]
        return self.library.encode(self.wall + "".join(known), out_type=str)[self.behind :] == known

    def _next(self, state: State, char: str) -> tuple[int, State]:
        """By how much one more character changes the token count, and the state after it."""
        token, change, live = char, len(char.encode()), []
        for before, begun, behind in state.open:
            text = begun + char
            kind = self.begins.get(text)
            if kind is None:
                continue
            # exactly one token may stand last; a character without a token is written as its bytes
            if kind & TOKEN and self.follows(before, text):
                token, change = text, behind + 1
            if kind & LONGER:
                live.append((before, text, behind))
        key = (*[(before, begun, behind - change) for before, begun, behind in live], (token, "", 0))
        if key not in self.states:
            if len(self.states) >= STATES:
                for known in (self.start, *self.states.values()):
                    known.next.clear()
                self.states.clear()
            self.states[key] = State(key)
        state.next[char] = found = (change, self.states[key])
        return found

    def steps(self, word: str) -> bytes:
        """By how much the token count changes with each character of a word."""
        state, changes = self.start, bytearray()
        for char in word:
            change, state = state.next.get(char) or self._next(state, char)
            changes.append(change & 255)
        return bytes(changes)

    def prefixes(self, text: str) -> bytes:
        """By how much the token count changes with each code point of a text: as many signed bytes as code points."""
        if not text:
            return b""
        steps = b"".join(map(self.words.__getitem__, self.split(BLANK + text.replace(" ", BLANK))))
        # the blank in front of the text is no code point of its own
        opened = int.from_bytes(steps[:1], signed=True) + int.from_bytes(steps[1:2], signed=True)
        return opened.to_bytes(1, signed=True) + steps[2:]


@functools.lru_cache(4)
def prefix_counts(model: str) -> PrefixCounts:
    return PrefixCounts(model)


def count_tokens(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``row`` (the row itself, as a struct), n_bytes, n_tokens and prefixes.

    ``model`` is the path of a byte-pair model of sentencepiece, found at the same place by every executor; no tokens for
    begin, end or other special strings are added, and such strings in a text are text. ``prefixes`` holds the change of
    the token count with each code point, see ``tokens_of`` and ``cut_at``. Null and empty texts have no bytes, tokens or
    prefixes. Long texts are counted whole. Equal rows stay rows of their own, an empty table gives no rows, and columns of
    any name may stand in ``docs``.
    """
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])

    def work(batches):
        counter = prefix_counts(model)
        for piece in pieces(batches):
            texts = column(piece, "text")
            # nothing here needs the collector, and its walks over the kept states would take a quarter of the time
            gc.disable()
            changes = [counter.prefixes(t) if t else b"" for t in texts.to_pylist()]
            gc.enable()
            totals = [int(np.frombuffer(c, dtype=np.int8).sum(dtype=np.int64)) for c in changes]
            sizes = pc.fill_null(pc.binary_length(texts.cast(pa.large_binary())), 0).cast(pa.int64())
            arrays = [column(piece, "row"), sizes, pa.array(totals, pa.int64()), pa.array(changes, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "n_bytes", "n_tokens", "prefixes"])

    out = StructType([StructField("row", docs.schema), *StructType.fromDDL("n_bytes long, n_tokens long, prefixes binary")])
    return docs.select(F.col(text).alias("text"), columns.alias("row")).mapInArrow(work, out)


def tokens_of(prefixes: Column, chars: Column) -> Column:
    """The tokens of the first ``chars`` code points (all, if there are fewer)."""

    @F.pandas_udf("long")
    def total(changes, ends):
        import pandas as pd

        return pd.Series([int(np.frombuffer(c or b"", dtype=np.int8)[: max(int(e), 0)].sum(dtype=np.int64)) for c, e in zip(changes, ends)])

    return total(prefixes, chars)


def cut_at(prefixes: Column, budget: Column) -> Column:
    """The code points of the longest prefix that has at most ``budget`` tokens."""

    @F.pandas_udf("long")
    def cut(changes, budgets):
        import pandas as pd

        found = []
        for c, b in zip(changes, budgets):
            fits = np.flatnonzero(np.cumsum(np.frombuffer(c or b"", dtype=np.int8), dtype=np.int64) <= b)
            found.append(int(fits[-1]) + 1 if len(fits) else 0)
        return pd.Series(found, dtype="int64")

    return cut(prefixes, budget)
