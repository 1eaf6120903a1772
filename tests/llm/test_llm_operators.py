"""The corpus operators against brute force on small tables, with nulls, empty and long texts, ties, repeated rows and odd columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from weirflow.llm import licences, lines, mixing, neardup, neighbours, quality, substrings, suffixes, templates, toxicity
from weirflow.llm.components import components
from weirflow.llm.texts import NULL_ID

SCHEMA = "doc_id long, text string, source string, k string, th string, row int, kept string, score double"


def table(spark, rows, schema=SCHEMA):
    full = [(*r, *[None] * (8 - len(r))) for r in rows] if schema == SCHEMA else rows
    return spark.createDataFrame(full, schema).repartition(3)


def corpus(seed, blocks, alphabet="ab c\n", rows=14):
    rng = random.Random(seed)
    pieces = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, blocks))) for _ in range(4)]
    out = [(None, "ab a"), (None, None), (3, ""), (4, None), (5, " \n\t "), (6, "ab a b"), (6, "ab a b"), (6, "other")]
    for i in range(rows):
        out.append((10 + i % 11, "".join(rng.choice(pieces + [rng.choice(alphabet) * 6]) for _ in range(rng.randint(0, 7)))))
    return out


def spans_of(mask):
    edges = np.flatnonzero(np.diff(np.concatenate(([0], np.asarray(mask, dtype=int), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


@pytest.mark.parametrize("seed", range(3))
def test_bytes_match_brute_force(spark, seed):
    rows = corpus(seed, 30, "abé \n") + [(90, "x" * 3000), (91, None)]
    length = 12
    texts = [(t or "").encode() for _, t in rows]
    starts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    want = Counter()
    for (doc_id, _), t in zip(rows, texts):
        mask = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if starts[t[i : i + length]] > 1:
                mask[i : i + length] = True
        kept = bytes(b for b, gone in zip(t, mask) if not gone)
        want[(doc_id, len(t), int(mask.sum()), len(spans_of(mask)), hashlib.sha256(kept).hexdigest())] += 1
    got = suffixes.drop_repeated_bytes(table(spark, rows), length=length, trigger=3, shard_bytes=200)
    assert Counter(tuple(r) for r in suffixes.digest(got).collect()) == want


@pytest.mark.parametrize("seed", range(3))
def test_substrings_match_brute_force(spark, seed):
    rows = corpus(seed, 30)
    length = 4
    key = [NULL_ID if d is None else d for d, _ in rows]
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for k, w in zip(key, words):
        for i in range(len(w) - length + 1):
            first[tuple(w[i : i + length])] = min(k, first.get(tuple(w[i : i + length]), k))
    want = Counter()
    for (doc_id, _), k, w in zip(rows, key, words):
        mask = np.zeros(len(w), dtype=bool)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < k:
                mask[i : i + length] = True
        kept = b" ".join(x for x, gone in zip(w, mask) if not gone)
        want[(doc_id, len(w), int(mask.sum()), hashlib.sha256(kept).hexdigest())] += 1
    got = substrings.drop_repeated_substrings(table(spark, rows), length=length, gram=2, shard_bytes=100)
    assert Counter(tuple(r) for r in substrings.digest(got).collect()) == want


def colliding(spark):
    """Two texts of one 32-bit hash."""
    texts = spark.range(400_000).select(F.concat_ws(" ", *[F.concat(F.lit(x), F.col("id")) for x in "abc"], F.lit("d e")).alias("text"))
    return texts.groupBy(F.hash("text").alias("h")).agg(F.sort_array(F.collect_list("text")).alias("texts")).where(F.size("texts") > 1).orderBy("h").first().texts[:2]


def test_rows_of_one_id_stay_apart(spark):
    one, two = colliding(spark)
    start = one[: one.index(" d")]
    rows = [(1, f"x {start}"), (7, one), (7, two)]
    got = substrings.drop_repeated_substrings(table(spark, rows), length=3, gram=2)
    want = Counter((d, len(t.split()), 3 * (t == one), hashlib.sha256((t if t != one else "d e").encode()).hexdigest()) for d, t in rows)
    assert Counter(tuple(r) for r in substrings.digest(got).collect()) == want
    got = suffixes.drop_repeated_bytes(table(spark, rows), length=len(start), trigger=3)
    assert Counter(r.removed for r in suffixes.digest(got).select(F.col(suffixes.digest(got).columns[2]).alias("removed")).collect()) == Counter([len(start)] * 2 + [0])
    alone = [(None, one), (None, two), (None, None), (None, ""), (None, None), (5, " "), (5, " "), (6, "a b"), (6, "a b")]
    kept = corpus_pipeline.drop_near_duplicates(spark, table(spark, alone), "").select("doc_id", "text").collect()
    assert Counter(map(tuple, kept)) == Counter(alone[:-1])


def test_lines_match_brute_force(spark):
    line = "a line that is long enough to count as one here"
    rows = [(i, f"  {line.upper()}\t\nshort\nown {i}") for i in range(6)] + [(5, line), (9, None), (8, ""), (None, f"{line}\n{line}\nend")]
    rows += [(20 + i, "four documents hold this line, and that is too few") for i in range(4)]
    got = lines.digest(lines.drop_repeated_lines(table(spark, rows), min_docs=5, batches=3))
    want = Counter()
    for doc_id, text in rows:
        parts = (text or "").split("\n")
        kept = [p for p in parts if p.strip(" \t\n\x0b\x0c\r").lower() != line or doc_id == 5]
        want[(doc_id, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in got.collect()) == want
    assert "É" in lines.drop_repeated_lines(table(spark, [(1, "É")])).first().kept


def test_equal_rows_drop_each_line_once(spark):
    line = "a line of forty characters or more, for sure"
    rows = [(i, f"{line}\nown {i}\n{line} ") for i in range(1, 7)] + [(2, f"{line}\nown 2\n{line} ")] * 3
    got = lines.digest(lines.drop_repeated_lines(table(spark, rows)))
    want = Counter()
    for i, text in rows:
        kept = text if i == 6 else f"own {i}"
        want[(i, 3, 0 if i == 6 else 2, hashlib.sha256(kept.encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in got.collect()) == want


def test_runs_are_compacted_by_level(spark):
    runs = lines.LineRuns(spark, 2, min_docs=2, fanout=2)
    for batch in ([(1, 1, 9), (2, 2, 9)], [(1, 1, 8)], [(1, 1, 7), (3, 3, 7)]):
        runs.add(spark.createDataFrame(batch, "h1 long, h2 long, k long"))
    assert [len(level) for level in runs.levels] == [1, 1]
    assert [tuple(r) for r in runs.settled().collect()] == [(1, 1, 9)]
    # the third batch could not change the settled line, so its run holds the new line only
    assert [r.h1 for r in runs.levels[0][0].collect()] == [3]


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 130)]
    star = [(1, i) for i in range(2, 40)]
    found = {r.node: r.label for r in components(spark.createDataFrame(path + star + [(7, 7)], "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 131)}, **{i: 1 for i in range(1, 40)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_rows():
    rng = random.Random(4)
    rows = []
    for group in range(6):
        words = [f"w{rng.randint(0, 400)}" for _ in range(60)]
        for copy in range(8):
            changed = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
                changed[rng.randrange(60)] = f"x{rng.randint(0, 10**6)}"
            rows.append((100 * group + copy, " ".join(changed)))
    return rows + [(700, None), (701, ""), (702, " \n"), (703, "two words"), (704, "two\twords"), (705, "two"), (None, "two  words"), (706, "w " * 5000), (706, "w " * 900)]


@pytest.mark.parametrize("chunk", [1024, 3])
def test_near_duplicates_match_brute_force(spark, chunk):
    rows = near_rows()
    words = [(t or "").split() for _, t in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and b and len(a & b) >= 0.8 * len(a | b):
                links[i].add(j)
    label = list(range(len(rows)))
    for _ in rows:
        label = [min([label[i], *(label[j] for j in links[i])]) for i in range(len(rows))]
    key = [NULL_ID if d is None else d for d, _ in rows]
    want = Counter()
    for i, (doc_id, _) in enumerate(rows):
        head = min(key[j] for j in range(len(rows)) if label[j] == label[i])
        want[(doc_id, None if head == NULL_ID else head, len(links[i]))] += 1
    got = neardup.near_duplicates(table(spark, rows), chunk=chunk, shard_bytes=2000)
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got.collect()) == want
    kept = [r for r in got.collect() if r.keeps]
    assert len({(r.class_id, r.th if r.class_id == r.doc_id and not r.n_links else None) for r in kept}) == len(kept)


def test_pruning_follows_the_posterior():
    assert neardup.least_matches(16, 0.8, 1e-6) <= neardup.least_matches(16, 0.8, 1e-3) < 13
    assert neardup.least_matches(96, 0.8, 1e-6) < 0.8 * 96


def test_mix_reaches_targets(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    rows += [(500, None, "a"), (501, "", "d"), (7, "again", "a"), (7, "again", "a"), (None, "x y", "b")]
    got = mixing.mix(table(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    total, caps, weights = 1.5 * sum(sizes.values()), {}, {}
    for i, source in enumerate(sorted(sizes, key=lambda s: (s is None, s or ""))):
        weights[source], caps[source] = (5, 2, 1)[i % 3], 2 * sizes[source]
    target, open_sources = {}, set(sizes)
    while True:
        rest = total - sum(target.values())
        full = {s for s in open_sources if caps[s] <= weights[s] * rest / sum(weights[x] for x in open_sources)}
        if not full:
            break
        target |= {s: caps[s] for s in full}
        open_sources -= full
    target |= {s: weights[s] * rest / sum(weights[x] for x in open_sources) for s in open_sources}
    by_size = {sizes[s]: s for s in sizes}
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(target[by_size[r.source_size]])
        assert r.taken == r.size * r.copies <= 2 * r.size and len(r.positions) == r.copies
        taken[by_size[r.source_size]] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 40
    places = [r.position for r in got if r.position is not None]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    again = mixing.mix(table(spark, rows[::-1]).repartition(7)).collect()
    assert Counter((r.doc_id, r.taken, r.position) for r in got) == Counter((r.doc_id, r.taken, r.position) for r in again)
    assert mixing.mix(table(spark, [])).count() == 0


def test_schedules_are_inverted(spark):
    schedule = ((0.0, 0.0), (0.25, 2.0), (0.5, 2.0), (1.0, 0.5))
    shares = spark.createDataFrame([(i / 20,) for i in range(21)], "share double")
    for share, time in shares.select("share", mixing.time_of(F.col("share"), schedule)).collect():
        grid = np.linspace(0, time, 20001)
        whole = np.linspace(0, 1, 20001)
        ts, ws = zip(*schedule)
        area = np.trapezoid(np.interp(grid, ts, ws), grid) / np.trapezoid(np.interp(whole, ts, ws), whole)
        assert area == pytest.approx(share, abs=1e-4)
    with pytest.raises(ValueError):
        mixing.segments(((0.0, 1.0), (0.0, 2.0)))


BENCHMARK = [
    (1, "Today Anna has 12 apples and gives 5 of them to Robert, so how many apples has Anna left today?"),
    (2, "A pipe that is 40 cm long is cut into pieces of equal size by the old workman"),
    (3, None),
    (4, ""),
    (5, "what remains of the day"),
]


def leaked(spark, rows):
    items = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in templates.leaks(table(spark, rows), items).collect()}


def test_leaks_and_slots(spark):
    filler = "there was nothing else to say about the matter at hand"
    found = leaked(
        spark,
        [
            (1, f"{filler} Today Anna has 12 apples and gives 5 of them to Robert,\nso how many apples has Anna left today? {filler}"),
            (2, f"{filler}. Today Mary has 30 apples and gives 8 of them to Peter, so how many apples has Mary left today? {filler}"),
            (3, f"{filler}. Today Mary has 30 apples and gives 8 of them to Peter, so how many apples has Susan left today? {filler}"),
            (4, f"A PIPE that is 75 mm long is cut into pieces of equal size by the old workman {filler}".lower()),
            (5, filler),
            (6, "What remains of the day"),
            (7, None),
            (8, ""),
            (1, "  "),
            (None, "what remains of the day"),
            (None, "what remains of the day"),
        ],
    )
    assert set(found) == {(1, 1), (2, 1), (4, 2), (6, 5), (None, 5)}
    assert found[(1, 1)].changed == 0 and found[(2, 1)].changed >= 3
    assert found[(4, 2)].n_slots >= 2 and found[(4, 2)].changed == 2
    assert templates.leaks(table(spark, []), spark.createDataFrame(BENCHMARK, "item_id long, text string")).count() == 0
    assert templates.leaks(table(spark, [(1, "a b")]), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_blocks_of_the_benchmark_give_the_same(spark):
    rows = [(1, "x " + BENCHMARK[0][1]), (2, BENCHMARK[1][1])]
    items = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    one, many = (templates.leaks(table(spark, rows), items, block_windows=b).drop("k", "th") for b in (1000, 4))
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, many.collect()))


def simple_tokens(text):
    return [("#", w) if w.isdigit() else (w, None) for w in text.split()]


def leak_by_brute_force(item, doc, window=8, min_share=0.5):
    """Whether a document of literals and numbers leaks an item, and the best share."""
    ours, theirs = simple_tokens(item), simple_tokens(doc)
    size = min(window, len(ours))
    starts = [s for s in range(len(ours) - size + 1) if any(v is None for _, v in ours[s : s + size])]
    verbatim = not starts
    if verbatim:
        ours, theirs = ([(f"{f}{v or ''}", None) for f, v in x] for x in (ours, theirs))
        starts = list(range(len(ours) - size + 1))
    counted = {i for s in starts for i in range(s, s + size)}
    lines = defaultdict(lambda: (set(), set()))
    for s in starts:
        for at in range(len(theirs) - size + 1):
            pairs = list(zip(ours[s : s + size], theirs[at : at + size]))
            if all(a[0] == b[0] for a, b in pairs):
                lines[at - s][0].add(s)
                lines[at - s][1].update((a[1], b[1]) for a, b in pairs if a[1] is not None)
    consistent = lambda slots: len({a for a, _ in slots}) == len({b for _, b in slots}) == len(slots)
    lines = {shift: x for shift, x in lines.items() if consistent(x[1])}
    best = 0
    for shift, (found, slots) in lines.items():
        for other, more in sorted(lines.items(), key=lambda x: (-len(x[1][0]), -x[0])):
            if abs(other - shift) <= window and consistent(slots | more[1]):
                found, slots = found | more[0], slots | more[1]
        best = max(best, len({i for s in found for i in range(s, s + size)}) / len(counted))
    return best if best >= min_share else None


def test_edited_leaks_match_brute_force(spark):
    rng = random.Random(9)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnopq") + rng.choice("rstuvw")
    items = [[word() if rng.random() < 0.8 else str(rng.randint(1, 99)) for _ in range(n)] for n in (27, 20, 16, 22, 40)]
    items[0][13], items[1][10], items[2][8] = "55", "mid", "mid"
    items += [[str(rng.randint(1, 999)) for _ in range(12)], [str(rng.randint(1, 999)) for _ in range(30)] + ["what", "comes", "next"]]
    filler = [word() for _ in range(60)]
    docs = []
    for item in items:
        for edit in range(7):
            new = list(item)
            if edit == 1:
                new[len(new) // 2 : len(new) // 2 + 1] = ["two", "words"]
            elif edit == 2:
                new[len(new) // 2] = "edited"
            elif edit == 3:
                del new[len(new) // 2]
            elif edit == 4:
                new = [str(int(w) + 1000) if w.isdigit() else w for w in new]
            elif edit == 5:
                new = new[: len(new) // 3]
            elif edit == 6:
                new = new[: len(new) // 2] + filler[:15] + new[len(new) // 2 :]
            docs.append(" ".join(filler[:20] + new + filler[20:]))
    texts = [" ".join(x) for x in items]
    want = {(d, i): share for d, doc in enumerate(docs) for i, item in enumerate(texts) if (share := leak_by_brute_force(item, doc)) is not None}
    found = templates.leaks(table(spark, list(enumerate(docs))), spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): pytest.approx(r.share) for r in found} == want
    # a value replaced by two words, an edited word in a short item, and a copy of numbers only
    assert {(1, 0), (8 + 1, 1), (16, 2), (35, 5), (42, 6)} <= set(want)


def test_names_at_sentence_starts_and_of_two_words(spark):
    asked = "Anna has 12 apples. She eats 3. Tom gives Anna 5 more. How many has Anna now?"
    items = spark.createDataFrame([(1, asked), (2, "the rope of Mary is 12 cm long and Mary cuts it into pieces of 3 cm each")], "item_id long, text string")
    rows = [
        (1, "Well. " + asked.replace("Anna", "Maria").replace("Tom", "Jo Ann Lee").replace("12", "30")),
        (2, "x the rope of Mary Ann is 40mm long and Mary Ann cuts it into pieces of 5mm each"),
        (3, "x the rope of Mary Ann is 40mm long and Peter cuts it into pieces of 5mm each"),
        (4, "how many apples she eats now is more than well known, and she knows how"),
    ]
    found = {(r.doc_id, r.item_id): r for r in templates.leaks(table(spark, rows), items).collect()}
    assert set(found) == {(1, 1), (2, 2)}
    assert found[(1, 1)].share == found[(2, 2)].share == 1
    assert (found[(1, 1)].changed, found[(2, 2)].changed) == (3, 4)


def test_an_ordinary_word_at_a_sentence_start_is_no_name(spark):
    items = spark.createDataFrame([(1, "Today the old man of the sea went home. Yesterday it rained")], "item_id long, text string")
    rows = [(1, "Today the old man of the sea went home. Yesterday it rained"), (2, "today and yesterday"), (3, "Anna the old man of the sea went")]
    found = {r.doc_id: r for r in templates.leaks(table(spark, rows), items).collect()}
    assert set(found) == {1} and found[1].n_slots == 0


def labelled(seed, n=500):
    rng = random.Random(seed)
    syllables = ["an", "er", "on", "st", "th", "ea", "ing", "ou", "re", "ti"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(10, 120))]
        bad = i % 4 == 0
        for _ in range(4 if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(["zwixfool", "grumblehead", "plonkface"])
        junk = i % 5 == 0
        rows.append((i, " | ".join(words) if junk else " ".join(words)))
        labels.append((i, 0 if junk else 1, int(bad)))
    return rows, labels


ODD = [(9001, None), (9002, ""), (9003, " \n"), (9004, "word " * 40000), (9004, "word " * 40000), (None, "an er")]


@pytest.mark.parametrize("operator, label, parts, least", [(toxicity, "toxic", 5, 0.9), (quality, "quality", 4, 0.9)])
def test_classifiers_on_held_out_rows(spark, operator, label, parts, least):
    rows, known = labelled(1)
    docs = table(spark, rows + ODD)
    labels = spark.createDataFrame(known + [(9999, 1, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    use = F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts != 0
    model = operator.fit(docs, labels, use)
    scored = operator.score(docs, model).select("row.doc_id", "score").collect()
    assert len(scored) == len(rows) + len(ODD)
    truth = {i: (q, t)[label == "toxic"] for i, q, t in known}
    held = [(r.score >= 0.5) == truth[r.doc_id] for r in scored if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % parts == 0]
    assert np.mean(held) >= least
    assert all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id in (9001, 9002, 9003)}) == 1
    assert operator.score(table(spark, []), model).count() == 0
    empty = operator.fit(table(spark, []), labels, use)
    assert [r.score for r in operator.score(table(spark, [(1, "a")]), empty).collect()] == [0.5]


def test_compression_tells_the_classes_apart():
    rows, known = labelled(3, 200)
    sample = [(t.encode(), y) for (_, t), (_, _, y) in zip(rows, known)]
    model = toxicity.train(sample, {0: 150, 1: 50})
    ordinary, toxic = model.compressors()
    window = model.carrier + b"grumblehead an er "
    assert len(toxic.compress(window)) < len(ordinary.compress(window))


def test_windows_are_compressed_one_by_one():
    rows, known = labelled(4, 120)
    model = toxicity.train([(t.encode(), y) for (_, t), (_, _, y) in zip(rows, known)], {0: 90, 1: 30})
    ordinary, toxic = model.compressors()
    text = b" ".join([b"grumblehead an er"] * 40) + b"\nst en"
    words = text.lower().split()
    gains = []
    for i in range(0, len(words) - model.window + toxicity.STEP, toxicity.STEP):
        body = model.carrier + b" ".join(words[i : i + model.window]) + b" "
        gains.append(len(ordinary.compress(body)) - len(toxic.compress(body)))
    reach = [sum(g >= t for g in gains) for t in toxicity.THRESHOLDS]
    assert max(reach) > 6
    want = [*np.log1p(reach), *(10 * n / len(gains) for n in reach), np.log1p(len(words) / model.window)]
    assert toxicity._evidence(text, model, ordinary, toxic, {}).tolist() == pytest.approx(want)


def test_word_vectors_come_from_all_documents(spark):
    rows = [(1, "An er st, en 12 unseen er"), (2, None), (3, ""), (4, "er"), (4, "er"), (5, "st en " * 9000), (None, "unseen")]
    held = table(spark, rows)
    index = quality.index_vectors()
    want = np.zeros((quality.BUCKETS, quality.DIMENSIONS))
    for _, text in rows:
        data = (text or "").encode()
        tokens = quality.Tokens(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
        both = list(zip(tokens.token, tokens.shape))
        for i, mine in enumerate(both):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(both):
                    for bucket in mine:
                        want[bucket] += index[both[j][0]] + index[both[j][1]]
    assert np.array_equal(quality.contexts(held), want)
    assert not quality.contexts(held.limit(0)).any()
    labels = spark.createDataFrame([(4, 0), (5, 1)], "doc_id long, quality int")
    data = np.frombuffer(b"unseen", dtype=np.uint8)
    bucket = quality.Tokens(data, np.array([0, 6])).token[0]
    assert quality.fit(held, labels, F.lit(True)).context[bucket].any()


def vectors(n=600, size=16, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, size))
    found = centers[rng.integers(0, 12, n)] + 0.5 * rng.normal(size=(n, size))
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(found)]


def test_neighbours_by_brute_force(spark):
    rows = vectors()
    odd = [(700, None), (701, [0.0] * 16), (702, [float("nan")] * 16), (703, [None] * 16), (704, [float("inf")] + [1.0] * 15), (705, []), (706, [1.0] * 3), (None, [1.0] * 16)]
    held = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(4)
    got = neighbours.nearest(held, held.where("vec_id % 20 = 0"), 5, chunk=50).collect()
    ids, v = np.array([i for i, _ in rows]), np.array([x for _, x in rows])
    by_query = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by_query[r.query_id].append(r)
    assert set(by_query) == set(range(0, 600, 20))
    recall = []
    for q, found in by_query.items():
        scores = v @ v[q]
        scores[q] = -np.inf
        order = np.lexsort((ids, -scores))[:5]
        assert [r.rank for r in found] == [1, 2, 3, 4, 5]
        assert [r.score for r in found] == sorted((r.score for r in found), reverse=True)
        assert all(r.score == pytest.approx(float(v[r.vec_id] @ v[q]), abs=1e-12) for r in found)
        recall.append(len({r.vec_id for r in found} & set(order.tolist())) / 5)
    assert np.mean(recall) >= 0.9


@pytest.mark.parametrize("scale", [1e-160, 1e-12, 1.0, 1e8, 1e160])
def test_neighbours_do_not_depend_on_the_scale(spark, scale):
    rows = vectors(200, 8, 3)
    v = np.array([x for _, x in rows])
    # 30 vectors that differ from the best one in the last bits only, and copies of it
    v = np.concatenate((v, v[7] * 3 * (1 + np.arange(30)[:, None] * 2.0**-50), np.repeat(v[7:8] * 4, 6, axis=0)))
    held = spark.createDataFrame([(i, (x * scale).tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(3)
    # the components as the table holds them, in a scale that does not overflow
    v = np.array([(x * scale) * 2.0 ** -math.frexp(scale)[1] for x in v])
    got = neighbours.nearest(held, held.where("vec_id in (7, 40, 205)"), 20, chunk=40, probes=128).collect()
    for q in (7, 40, 205):
        scores = np.zeros(len(v))
        for a, b in zip(v.T, v[q]):
            scores += b * a
        scores[q] = -np.inf
        want = np.lexsort((np.arange(len(v)), -scores))[:20].tolist()
        found = [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q]
        assert len(set(found) & set(want)) >= 18, (q, found, want)
        assert found == sorted(found, key=lambda i: (-scores[i], i))


def test_one_id_with_many_vectors_takes_one_place(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(30)] + [(99, (rng.normal(size=4) + 5).tolist()) for _ in range(40)]
    held = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(held, held.where("vec_id = 3"), 5, chunk=200, probes=1, tables=1, functions=1, width=1e6).collect()
    assert len({r.vec_id for r in got}) == len(got) == 5


@pytest.mark.parametrize("n", [21, 10, 300])
def test_every_query_gets_all_its_neighbours(spark, n):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(n, 16))
    if n == 300:
        v[7] *= 30
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    held = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    extra = spark.createDataFrame([(-1, (-v[3]).tolist())], held.schema)
    # one cell of each table, so that many queries are short
    got = neighbours.nearest(held, held.unionByName(extra), 20, chunk=50, probes=1).collect()
    sizes = Counter(r.query_id for r in got)
    assert sizes == {i: min(20, n - (i >= 0)) for i in range(-1, n)}
    if n < 300:
        for q, x in [(-1, -v[3]), *enumerate(v)]:
            scores = v @ x
            order = [int(i) for i in np.argsort(-scores) if i != q][:20]
            assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == order


def test_fewer_functions_where_probes_do_not_reach_the_recall():
    v = np.random.default_rng(2).normal(size=(500, 64))
    start = neighbours.Tables(float(np.linalg.norm(v, axis=1).max()), 64, tables=2, width=0.5)
    fitted = neighbours.fit_probes(start, v, 20)
    keys, probed = fitted.keys(v), fitted.probe_keys(v[:200])
    scores = v[:200] @ v.T
    np.fill_diagonal(scores, -np.inf)
    near = np.argsort(-scores, axis=1)[:, :20]
    met = (keys[near][:, :, :, None] == probed[:, None]).any(axis=(2, 3))
    assert fitted.functions < start.functions
    assert met.mean() >= 0.96


def test_equal_vectors_tie_by_id(spark):
    rows = [(i, [1.0, 2.0]) for i in range(30)] + [(30, [1.0, 1.0])] * 2
    held = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(held, held.where("vec_id in (0, 25)"), 3)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got.collect()) == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (25, 1, 0), (25, 2, 1), (25, 3, 2)]
    few = neighbours.nearest(held.where("vec_id > 28"), held.where("vec_id = 30"), 3).collect()
    assert [tuple(r)[:3] for r in few] == [(30, 1, 29)]
    assert neighbours.nearest(held.limit(0), held, 3).count() == 0


@pytest.mark.parametrize("kind", ["float", "double"])
def test_a_vector_is_moved_once_and_not_for_each_table(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "scratch_path", lambda _, label: f"{tmp_path}/{label}-{len(list(tmp_path.iterdir()))}")
    v = np.random.default_rng(5).normal(size=(3000, 32)).astype(np.float32)
    held = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], f"vec_id long, embedding array<{kind}>")
    assert neighbours.nearest(held, held.where("vec_id % 20 = 0"), 5).count() == 750
    written = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert written < 2 * v.size * (4 if kind == "float" else 8)


@pytest.mark.parametrize("few", [0, 1])
@pytest.mark.parametrize("probes", [1, 16, None])
def test_a_block_finds_the_best_that_share_a_cell(monkeypatch, few, probes):
    monkeypatch.setattr(neighbours, "FEW", few)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(5000, 8)) * rng.choice([1e-25, 0.3, 1.0], size=(5000, 1))
    v[4000:4040] = v[17] * (1 + np.arange(40)[:, None] * 2.0**-50)
    ids = rng.integers(0, 4500, 5000)
    own, query = v[:60].copy(), ids[:60].copy()
    tables = probes and neighbours.Tables(float(np.linalg.norm(v, axis=1).max()), 8, width=1.4, probes=probes)
    block = neighbours.Block(ids, v, tables, 20)
    row, vec, score = block.search(query, own)
    scores = np.zeros((60, 5000))
    for a, b in zip(own.T, v.T):
        scores += a[:, None] * b
    shares = np.ones((60, 5000), dtype=bool)
    if probes:
        probed, held = tables.probe_keys(own), tables.keys(v)
        shares = np.array([(held[:, :, None] == p).any(axis=(1, 2)) for p in probed])
        assert 0 < shares.mean() < 1
    for q in range(60):
        best = {}
        for j in np.flatnonzero(shares[q] & (ids != query[q])):
            best[ids[j]] = max(best.get(ids[j], -np.inf), scores[q, j])
        want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:20]
        assert list(zip(vec[row == q].tolist(), score[row == q].tolist())) == want


def test_unlisted_licences_are_unknown(spark):
    plain = [(i, f"the river {i} ran past the old mill and the children of town {i % 17} sat by it") for i in range(200)]
    unlisted = [
        "Licensed under the Boost Software License, Version 1.0.",
        "This work is licensed under the Eclipse Distribution License, version 1.0.",
        "Released under the Zlib License.",
    ]
    listed = [(family, text) for family, texts in licences.TEMPLATES.items() for text in texts]
    long = " ".join(["the mill by the river was old"] * 30)
    docs = plain + [(1000 + i, text) for i, text in enumerate(unlisted)] + [(2000 + i, text) for i, (_, text) in enumerate(listed)]
    docs += [(3000, f"{long} {listed[0][1]} {long}"), (2000, listed[0][1]), (None, listed[0][1])]
    model = licences.fit(table(spark, docs))
    rows = licences.scan(table(spark, docs), model).collect()
    found = {r.doc_id: r.family for r in rows}
    assert 0 < model.least_own < 1
    assert all(found.get(1000 + i, licences.UNKNOWN) == licences.UNKNOWN for i in range(len(unlisted)))
    assert found[1000] == licences.UNKNOWN
    assert {2000 + i: family for i, (family, _) in enumerate(listed)} == {k: v for k, v in found.items() if k is not None and 2000 <= k < 3000}
    assert found[None] == listed[0][0] and sum(r.doc_id == 2000 for r in rows) == 2
    assert not any(k is not None and k < 1000 for k in found)
    assert found.get(3000, listed[0][0]) in (listed[0][0], licences.UNKNOWN)


def test_masked_notices_and_weighed_shares(spark):
    few = defaultdict(set)
    words = lambda text: [w for w in re.split(r"[^\w.+-]+|\.(?!\w)", text.lower()) if w]
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            for w in words(text):
                few[w].add(family)
    for r in licences.varied_notices(spark, 2).where("family = 'unknown'").collect():
        kept = [w for w in r.words if w in few]
        assert all(len(few[w]) > licences.FEW for w in kept) and len(kept) >= len(r.words) / 2
    grams = lambda ws: set(ws) | {" ".join(p) for p in zip(ws, ws[1:])}
    uses = defaultdict(set)
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            for g in grams(words(text)):
                uses[g].add(family)
    weight = lambda gs: sum(1 / len(uses[g]) ** 2 if g in uses else 1 for g in gs)
    ours = grams(words("Licensed under the Boost Software License, Version 1.0."))
    each = [grams(words(t)) for t in licences.TEMPLATES["Apache-2.0"]]
    want = max(weight(t & ours) / min(weight(t), weight(ours)) for t in each)
    told = licences.known_templates(spark).where("predicted = 'Apache-2.0'").withColumn("grams", F.array(*map(F.lit, sorted(ours))))
    got = told.select(F.array_max(F.transform("known", lambda t: licences.own_similarity(t, F.col("grams")))).alias("own")).first().own
    assert got == pytest.approx(want) and want < 0.2


def test_no_paragraph_like_a_template_is_left_out(spark):
    words = [r.words for r in licences.templates(spark).collect()]
    assert not any(a == b for ws in words for a, b in zip(ws, ws[1:]))
    rng = random.Random(5)
    said = sorted({w for ws in words for w in ws})
    rows = []
    for i in range(1500):
        own = rng.choice(words)
        at = rng.randrange(len(own))
        mine = own[at : at + rng.randint(0, 4)] if rng.random() < 0.7 else rng.sample(said, rng.randint(0, 3))
        filler = [rng.choice(["mill", "river", "old", rng.choice(said)]) for _ in range(rng.choice([0, 1, 2, 3, 8, 20]))]
        rows.append((i, " ".join(filler[:2] + mine + filler[2:])))
    held = table(spark, rows).select("doc_id", licences.words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    known = F.broadcast(licences.known_templates(spark).where("predicted = 'unknown'"))
    told = held.withColumn("grams", licences.grams_of(F.col("words"))).crossJoin(known).withColumn("like", licences._largest(licences.similarity))
    for least in (0.0, 0.1, 0.25, 0.5):
        got = told.select("like", licences.may_be_alike(spark, F.col("words"), least).alias("kept")).collect()
        assert all(r.kept for r in got if r.like >= least)
        assert least == 0 or any(not r.kept for r in got)


def test_licences(spark):
    rows, _ = labelled(5, 120)
    notices = [(900, "Released under the MIT License."), (901, "an er\nLicensed under the Apache License, Version 2.0.\nst"), (902, "This work is licensed under the GNU General Public License, version 3.")]
    docs = table(spark, rows + notices + ODD)
    model = licences.fit(docs)
    found = {(r.doc_id, r.paragraph): r.family for r in licences.scan(docs, model).collect()}
    assert found == {(900, 0): "MIT", (901, 1): "Apache-2.0", (902, 0): "GPL"}
    assert licences.scan(table(spark, []), model).count() == 0


def test_all_ordinary_paragraphs_train_or_calibrate(spark):
    rng = random.Random(9)
    said = sorted({w for ts in licences.TEMPLATES.values() for t in ts for w in re.split(r"[^\w.+-]+|\.(?!\w)", t.lower()) if w})
    line = lambda: " ".join(rng.choice([rng.choice(said), f"w{rng.randrange(500)}"]) for _ in range(rng.randint(1, 30)))
    rows = [(i, "\n".join(line() for _ in range(rng.randint(1, 12)))) for i in range(900)]
    rows += rows[:200] + [(None, rows[0][1]), (5, None), (6, ""), (7, " \n,\n"), (8, rows[3][1].upper())]
    words = lambda text: tuple(w for w in re.split(r"[^\w.+-]+|\.(?!\w)", text.lower()) if w)
    want = {ws for _, text in rows for ws in map(words, (text or "").split("\n")) if ws and 2 * len(set(ws) & set(said)) < len(set(ws))}
    assert len(want) > 2000
    docs = table(spark, rows)
    told = licences.ordinary(docs, "doc_id", "text", "\n")
    n, learn, held = told.agg(F.count("*"), F.sum("learn"), F.sum("held")).first()
    assert learn + held == len(want) and min(learn, held) > 0.4 * len(want) and n <= len(want)
    assert told.count() == told.select("grams", "beside").distinct().count()


def test_features_are_grams_of_template_words(spark):
    texts = ["Licensed under the Boost licensed UNDER", "mill", "the", "", "the mill the river of the old", " ".join(["mill"] * 9 + ["of", "the"])]
    said = set(licences.words_of_templates(spark))
    held = table(spark, list(enumerate(texts))).select("doc_id", licences.words_of(F.col("text")).alias("words"))
    got = held.select("words", licences.features_of(licences.codes_of(spark, F.col("words"))).alias("grams")).collect()
    number = lambda *ws: spark.range(1).select(F.hash(*[F.hash(F.lit(w)) for w in ws]) if len(ws) > 1 else F.hash(F.lit(ws[0]))).first()[0]
    for r in got:
        ws = r.words
        want = {number(w) for w in ws if w in said} | {number(a, b) for a, b in zip(ws, ws[1:]) if a in said and b in said}
        others = sum(w not in said for w in ws)
        assert r.grams == sorted(want | {1 + min(int(math.log2(others + 1)), 3)})


def test_the_probability_is_calibrated_on_all_held_paragraphs(spark, monkeypatch):
    # a paragraph in 40 has much of a notice; those of the first 400 texts alone don't tell how many
    tricky = lambda i: f"see w{i} x{i} licensed under the y{i} z{i} license version q{i} r{i}"
    rows = [(i, tricky(i) if i % 40 == 0 else f"the river {i} ran past the old mill and the children of town {i % 17} sat by it") for i in range(2400)]
    docs = table(spark, rows)
    given = []
    probabilities = licences._probabilities
    monkeypatch.setattr(licences, "_probabilities", lambda frame, learned: given.append((frame, learned)) or probabilities(frame, learned))
    model = licences.fit(docs, variants=8, least=0.1)
    monkeypatch.undo()
    told = licences.ordinary(docs, "doc_id", "text", "\n").where("held > 0")
    scored = licences._probabilities(told, model.learned).select((1 - F.col("p")[0]).alias("p"), "held").collect()
    total = sum(r.held for r in scored)
    assert len(given) == 1 and total > 1000
    step = 1 / licences.STEPS
    assert sum(r.held for r in scored if r.p <= model.least + 1e-9) >= 0.995 * total
    assert model.least == 0.1 or sum(r.held for r in scored if r.p <= model.least - step - 1e-9) < 0.995 * total or model.least == 0.99
