"""Manifest, token counts and divergence of sources against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirflow.llm import divergence, manifest, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, pos int, path string, row string, n int, term string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 2, "t") for r in rows], SCHEMA).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, extra=0):
    doc_id, text, lang, source, n_chars = row
    values = (doc_id, source, lang, n_chars + extra if n_chars is not None else None, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climbed(nodes, fanout):
    """The root and, for each node, its siblings level by level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parents, held = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for slot in range(len(run)):
                for i in owners[at + slot]:
                    paths[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            parents.append(sha("".join(run)))
            held.append([i for o in owners[at : at + fanout] for i in o])
        nodes, owners = parents, held
    return nodes[0], paths


def documents(seed, n):
    rng = random.Random(seed)
    rows = [(None, None, None, None, None), (None, "", "", "s", 0), (3, "é ñ", "en", None, 4), (3, "é ñ", "en", None, 4), (3, "b", "en", "", 1)]
    rows += [(None, "same", "hot", "s", 4)] * 9 + [(2**62, "x" * 5000, "one", "s", 5000)]
    langs = [None, "", "en", "hot", "日本", "de"]
    return rows + [(rng.randint(-9, 50), rng.choice(["a b", "c", None, "ö"]), rng.choice(langs), rng.choice(["s", "t"]), rng.randint(0, 9)) for _ in range(n)]


@pytest.mark.parametrize("fanout, levels, n", [(2, 2, 60), (2, 10, 33), (3, 1, 47)])
def test_manifest_matches_brute_force(spark, fanout, levels, n):
    rows = documents(n, n)
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, inner = {}, {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        tops[g], inner[g] = climbed([x[2] for x in groups[g]], fanout)
    root, outer = climbed([tops[g] for g in names], fanout)
    want = Counter()
    for g, rest in zip(names, outer):
        for (_, _, leaf, row), path in zip(groups[g], inner[g]):
            siblings = "".join(a + b for a, b in path + rest)
            seen = node = leaf_of(row, 1 if row[1] == "c" else 0)
            for a, b in path + rest:
                node = sha(a + node + b)
            want[(row[0], leaf, tops[g], root, sha(siblings), seen, node, node == root)] += 1
    docs = table(spark, rows)
    more = F.when(F.col("text") == "c", 1).otherwise(0)
    seen = manifest.leaf([F.col(c) + more if c == "n_chars" else F.col(c) for c in manifest.FIELDS])
    got = manifest.manifest(docs, fanout=fanout, levels=levels, carried={"seen": seen}).withColumn("proof", manifest.proof(F.col("path")))
    got = manifest.verify(got, "seen").select("doc_id", "leaf", "subroot", "root", "proof", "seen", "folded_root", "verified")
    assert Counter(tuple(r) for r in got.collect()) == want
    assert {r[-1] for r in want} == {True, False}


def test_manifest_of_nothing_and_of_one_row(spark):
    assert manifest.manifest(table(spark, [])).count() == 0
    row = manifest.verify(manifest.manifest(table(spark, [(1, None, None, None, None)])), "leaf").first()
    assert row.leaf == row.subroot == row.root and row.path == [] and row.verified


public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "é", "日本", "the", "ing", "<s>", "</s>", "<0x0A>", "▁", "\x00", "😀", "1", "--", "    ", "\r\n", "ния", "ﬁ", "xxxxx", " " * 40]


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=MODEL)


def test_every_prefix_has_the_librarys_count(library):
    rng, counter = random.Random(5), tokens.PrefixCounts(MODEL)
    for _ in range(150):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 20)))
        counts = np.cumsum(np.frombuffer(counter.prefixes(text), dtype=np.int8), dtype=int)
        assert counts.tolist() == [len(library.encode(text[:i])) for i in range(1, len(text) + 1)], text


def test_counts_stay_exact_when_states_are_dropped(monkeypatch, library):
    monkeypatch.setattr(tokens, "STATES", 5)
    monkeypatch.setattr(tokens, "KEPT", 4)
    counter = tokens.PrefixCounts(MODEL)
    text = "the theing xxxxx\n\nния  日本 the a<s>b " * 3
    counts = np.cumsum(np.frombuffer(counter.prefixes(text), dtype=np.int8), dtype=int)
    assert counts.tolist() == [len(library.encode(text[:i])) for i in range(1, len(text) + 1)]
    assert len(counter.states) <= 5


def test_words_are_kept_within_a_bound(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 3)
    words = tokens.Words(lambda word: bytes(len(word)))
    for word in ["a", "b", "c", "d", "x" * 100, "a"]:
        assert words[word] == bytes(len(word)) and len(words) <= 3
    assert "x" * 100 not in words


def test_counts_truncation_and_budget(spark, library):
    rng = random.Random(6)
    texts = [None, "", " ", "the same text", "the same text", "ab " * 30000, "x" * 20000] + ["".join(rng.choice(PARTS) for _ in range(30)) for _ in range(20)]
    docs = table(spark, [(i // 2, t, None, None, None) for i, t in enumerate(texts)])
    budget, chars = 7, 9
    got = tokens.count_tokens(docs, MODEL).select(
        "row.doc_id", "row.text", "row.row", "n_bytes", "n_tokens",
        tokens.tokens_of(F.col("prefixes"), F.lit(chars)).alias("upto"), tokens.cut_at(F.col("prefixes"), F.lit(budget)).alias("cut"),
    )
    want = Counter()
    for i, t in enumerate(texts):
        t0 = t or ""
        cut = max(j for j in range(min(len(t0), 400) + 1) if len(library.encode(t0[:j])) <= budget)
        want[(i // 2, t, "z", len(t0.encode()), len(library.encode(t0)), len(library.encode(t0[:chars])), cut)] += 1
    assert Counter(tuple(r) for r in got.collect()) == want
    assert tokens.count_tokens(table(spark, []), MODEL).count() == 0


def test_transducer_is_minimal_and_ordered():
    rng = random.Random(7)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))) for _ in range(200)} | {"é".encode() * 500})
    built = divergence.Transducer(words)
    assert [built.place(w) for w in words] == list(range(len(words)))
    assert built.place(b"") == built.place(b"d") == built.place(b"abcabca") == built.place("é".encode()) == -1
    assert list(built.terms()) == words
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    futures = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes if len(p) < 20}
    tail = {w[i:] for w in words[-1:] for i in range(20, len(words[-1]) + 1)}
    assert len(built.arcs) == len(futures | {frozenset([t]) for t in tail})
    assert divergence.Transducer([]).place(b"a") == -1


def test_rates_of_large_counts_are_exact():
    count, total = np.array([0, 5, 10**13, 7 * 10**15]), np.array([3, 5, 10**13 + 7, 9 * 10**15])
    assert divergence.rate(count, total).tolist() == [1 + 10**9 * (int(c) + 1) // int(t) for c, t in zip(count, total)]


@pytest.mark.parametrize("seed, small", [(0, True), (1, True), (2, False)])
def test_divergence_matches_brute_force(spark, monkeypatch, seed, small):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "É", "é", "a1b", "ab", "abc", "zz", "日本語", "x" * 300, "don't", "..", "q"]
    rows = [(1, None, None, None, 0), (1, "", "", "", 0), (2, "rare once", "xx", "s", 0), (2, None, "xx", "t", 0), (3, None, "en", "empty", 0)]
    for i in range(60):
        words = [rng.choice(vocabulary[: 5 + i % 9]) for _ in range(rng.randint(0, 12))] + ["hot"] * (i % 3)
        rows.append((i % 20, " ".join(words), rng.choice(["en", "de", None]), rng.choice(["s", "t", "u", None, "S é"]), 0))
    rows += rows[-1:] * 3
    used, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in found]
        used[lang or "", source or ""].update(found)
        seen[lang or ""].update(set(found))
        groups[lang or ""].add(source or "")
    want = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in seen[lang].items() if n >= 3)

        def rates(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept}

        whole = rates(sum((used[lang, s] for s in sources), Counter()))
        p = {s: rates(used[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources if o != s]
            own = [(-((p[s][t] - whole[t]) ** 2 // whole[t]), t.encode()) for t in kept if used[lang, s][t] and p[s][t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(own)[:4])):
                want |= {(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)}
    sizes = dict(shard_terms=4, fold_terms=5, block_terms=2) if small else {}
    got = divergence.divergence(table(spark, rows), top=4, **sizes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_folds_are_sent_before_they_grow(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "FOLDS", 3)
    batch = pa.RecordBatch.from_pydict({"lang": ["a"] * 4, "source": ["s", "t", "s", "s"], "text": ["x y", "y z", "x x", "w"]})
    counts = Counter()
    for part in divergence._folds([("a", b"x")], [5])(iter([batch])):
        assert sum(part["size"].to_pylist()) <= 4
        for row in part.to_pylist():
            listed, n = row["terms"].split(b" "), np.frombuffer(row["counts"], dtype=np.int64)
            assert row["shard"] == 5 and row["size"] == len(listed) == len(n)
            counts.update({(row["source"], t): int(c) for t, c in zip(listed, n)})
    assert counts == {("s", b"x"): 3, ("s", b"y"): 1, ("t", b"y"): 1, ("t", b"z"): 1}


def test_divergence_of_nothing(spark):
    assert divergence.divergence(table(spark, [])).count() == 0
