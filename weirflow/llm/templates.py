"""Benchmark decontamination by template windows.

Texts become tokens: numbers, units after a number (glued or not) and names become typed placeholders, other words lose their
case and outer punctuation. A capitalised word is a name unless it is ordinary, that is, unless all documents and the benchmark
write it in lower case at least as often as with a capital inside a sentence; a run of such words is one name. An ordinary word
with a capital is a name of its own inside a sentence, and a literal at the start of one.

An item's windows of tokens are its templates. A document leaks an item if its windows cover enough of the item's tokens, and
if the values in the slots change consistently: one value of the item always becomes the same value in the document, and two
never become one. Windows on one alignment (shift) belong together; consistent ones on shifts nearby are added, so that
inserted, deleted and edited words cost the tokens next to them only.

Only built-in functions are used. A window can only match where its rarest literal words stand, so documents are first
picked by these and by the words around them, up to the next name or unit; the frequencies are counted over all documents. Only
the picked ones become tokens and are compared. The
benchmark goes in blocks, so that what is broadcast has a fixed bound however large the benchmark is.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.texts import key_of
from weirflow.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
PUNCTUATION = ".,;:!?()[]{}<>\"'`|*_~«»“”‘’„…¿¡"
#: Units of measure that count as a slot when they follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t ton tons oz lb lbs pound pounds ml cl l liter liters litre "
    "litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "percent % cent cents dollar dollars euro euros usd eur gbp mph kph km/h °c °f k w kw v a hz khz mhz ghz b kb mb gb tb"
).split()
#: Windows of one block of the benchmark; a window is broadcast as one row of fewer than 100 bytes.
BLOCK_WINDOWS = 200_000


#: A number with a unit glued to it.
GLUED = r"(?<!\S)([^\p{L}\s]*[0-9][^\p{L}\s]*?)((?i)" + "|".join(sorted(map(re.escape, UNITS), key=len, reverse=True)) + r")(?=[" + re.escape(PUNCTUATION) + r"]*(?!\S))"


def core(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(PUNCTUATION)))


def _number(word: Column) -> Column:
    return word.rlike(r"^[^\p{L}]*[0-9][^\p{L}]*$")


def _capital(word: Column) -> Column:
    return (core(word) != F.btrim(word, F.lit(PUNCTUATION))) & word.rlike(r"^[^\p{L}\p{N}]*\p{Lu}")


def _inside(before: Column) -> Column:
    """Whether a word after ``before`` stands inside a sentence."""
    return before.isNotNull() & ~F.coalesce(F.right(F.rtrim(before, F.lit("\"'”’»)")), F.lit(1)).isin(*".!?:"), F.lit(True))


def _words(text: Column) -> Column:
    return F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r")), SPACE)


def _once(value: Column) -> Column:
    """A generator of one row: the value is made once, and not again for each use of it."""
    return F.explode(F.array(value))


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, often, ordinary) of all words in the arrays ``words``. Equal spellings are counted before they are looked into."""
    each = words.select("words", F.posexplode("words").alias("pos", "raw"))
    before = F.when(F.col("pos") > 0, F.get("words", F.col("pos") - 1))
    inside = F.when(F.col("raw") != F.lower("raw"), _inside(before)).otherwise(False)
    spelt = each.select("raw", inside.alias("inside")).groupBy("raw", "inside").agg(F.count("*").alias("n"))
    lower = core(F.col("raw")) == F.btrim(F.col("raw"), F.lit(PUNCTUATION))
    spelt = spelt.select(core(F.col("raw")).alias("word"), "n", lower.alias("lower"), (F.col("inside") & _capital(F.col("raw"))).alias("inside"))

    def total(flag: str) -> Column:
        return F.sum(F.when(F.col(flag), F.col("n")).otherwise(0))

    counts = spelt.groupBy("word").agg(F.sum("n").alias("often"), total("lower").alias("lower"), total("inside").alias("inside"))
    return counts.select("word", "often", ((F.col("lower") > 0) & (F.col("lower") >= F.col("inside"))).alias("ordinary"))


def tokens(texts: DataFrame, keys: list[str], known: DataFrame) -> DataFrame:
    """(keys, forms): the tokens of each text as (form, value); the value is null in a literal. ``known`` is a ``vocabulary``."""
    split = texts.select(*keys, _once(_words(F.regexp_replace(F.coalesce("text", F.lit("")), GLUED, "$1 $2"))).alias("words")).where("words[0] <> ''")
    capitals = split.select(*keys, F.explode(F.array_distinct(F.transform(F.filter("words", _capital), core))).alias("word")).distinct()
    ordinary = capitals.join(known.where("ordinary").select("word"), "word").groupBy(*keys).agg(F.collect_set("word").alias("ordinary"))
    split = split.join(ordinary, keys, "left").withColumn("ordinary", F.coalesce("ordinary", F.array().cast("array<string>")))

    def mark(word: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("words", i - 1))
        plain = core(word)
        unit = plain.isin(*UNITS) & F.coalesce(_number(before), F.lit(False))
        usual = F.array_contains("ordinary", plain)
        kind = F.when(_number(word), "<num>").when(unit, "<unit>").when(_capital(word), F.when(~usual, "<name>").when(_inside(before), "<own>"))
        return F.struct(plain.alias("plain"), kind.alias("kind"), word.rlike(r"^[\p{L}\p{N}]").alias("opens"), word.rlike(r"[\p{L}\p{N}]$").alias("goes"))

    marked = split.select(*keys, _once(F.transform("words", mark)).alias("m"))

    def begins(i: Column) -> Column:
        here, last = F.get("m", i), F.get("m", i - 1)
        joins = here.kind.eqNullSafe("<name>") & last.kind.eqNullSafe("<name>") & here.opens & last.goes
        return (i == 0) | ~F.coalesce(joins, F.lit(False))

    cut = marked.select(*keys, "m", _once(F.filter(F.sequence(F.lit(0), F.size("m") - 1), begins)).alias("cuts"))

    def token(start: Column, t: Column) -> Column:
        kind = F.get("m", start).kind
        size = F.coalesce(F.get("cuts", t + 1), F.size("m")) - start
        value = F.array_join(F.transform(F.slice("m", start + 1, size), lambda x: x.plain), " ")
        form = F.when(kind == "<own>", "<name>").otherwise(F.coalesce(kind, F.get("m", start).plain))
        return F.struct(form.alias("form"), F.when(kind.isNotNull(), value).alias("value"))

    return cut.select(*keys, _once(F.transform("cuts", token)).alias("forms"))


def _verbatim(forms: str) -> Column:
    """Tokens whose values are part of their form."""
    return F.transform(forms, lambda x: F.struct(F.when(x.value.isNotNull(), F.concat(x.form, x.value)).otherwise(x.form).alias("form"), F.lit(None).cast("string").alias("value")))


def _hash(forms: Column) -> Column:
    return F.xxhash64(F.transform(forms, lambda x: x.form))


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, item, start, size, n, verbatim, forms, wh): the template windows of each item's ``forms``; a shorter item is one window.

    Windows without a literal are left out; ``n`` counts the tokens in the others. An item that has no others is kept
    with its values as literals (``verbatim``), so that copies of it are found.
    """
    size = F.least(F.size("forms"), F.lit(window))
    literal = F.exists("forms", lambda x: x.value.isNull())
    windows = lambda: F.transform(F.sequence(F.lit(0), F.size("forms") - size), lambda i: F.struct(i.alias("start"), F.slice("forms", i + 1, size).alias("forms")))
    open_windows = F.filter(windows(), lambda w: F.exists(w.forms, lambda x: x.value.isNull()))
    items = items.withColumn("verbatim", ~literal).withColumn("forms", F.when(literal, F.col("forms")).otherwise(_verbatim("forms")))
    items = items.select("item_id", "item", "verbatim", size.alias("size"), _once(open_windows).alias("w"))
    n = F.size(F.array_distinct(F.flatten(F.transform("w.start", lambda i: F.sequence(i, i + F.col("size") - 1)))))
    placed = items.select("item_id", "item", "verbatim", "size", n.alias("n"), F.explode("w").alias("w"))
    return placed.select("item_id", "item", "w.start", "size", "n", "verbatim", "w.forms").withColumn("wh", _hash(F.col("forms")))


def _probes(windows: DataFrame, known: DataFrame) -> DataFrame:
    """(wh, size, word, offset, word2, apart, before, run): the rarest literal of each window, the rarest at a sure distance of it, and all around it.

    A name or unit in between makes the distance unsure, since both can be more or fewer words in a text. ``run`` holds the tokens
    from the last unsure one to the next, ``before`` of them before the rarest literal; numbers in it are null.
    """
    literal = windows.select("wh", "size", "forms", F.posexplode("forms").alias("offset", "f")).where("f.value IS NULL")
    loose = F.transform("forms", lambda x: x.value.isNotNull() & (x.form != "<num>")).alias("loose")
    said = F.transform("forms", lambda x: F.when(x.value.isNull(), x.form)).alias("said")
    literal = literal.select("wh", "size", loose, said, "offset", F.col("f.form").alias("word")).distinct()
    literal = literal.join(known.select("word", "often"), "word", "left").withColumn("often", F.coalesce("often", F.lit(0).cast("long")))
    sorted_ = F.array_sort(F.collect_list(F.struct("often", "word", "offset"))).alias("r")
    probes = literal.groupBy("wh", "size").agg(sorted_, F.first("loose").alias("loose"), F.first("said").alias("said"))
    first = F.col("r")[0]
    low, high = (lambda x, f=f: f(x.offset, first.offset) for f in (F.least, F.greatest))
    sure = F.filter(F.slice("r", 2, 2**31 - 1), lambda x: ~F.exists(F.slice("loose", low(x) + 1, high(x) - low(x)), lambda y: y))
    unsure = F.filter(F.sequence(F.lit(0), F.size("loose") - 1), lambda i: F.get("loose", i))
    opens = F.coalesce(F.array_max(F.filter(unsure, lambda i: i < first.offset)) + 1, F.lit(0))
    ends = F.coalesce(F.array_min(F.filter(unsure, lambda i: i > first.offset)), F.size("loose"))
    probes = probes.select("wh", "size", first.word.alias("word"), first.offset.alias("offset"), F.get(sure, F.lit(0)).alias("s"), "said", opens.alias("opens"), ends.alias("ends"))
    return probes.select(
        "wh",
        "size",
        "word",
        "offset",
        F.col("s.word").alias("word2"),
        (F.col("s.offset") - F.col("offset")).alias("apart"),
        (F.col("offset") - F.col("opens")).alias("before"),
        F.slice("said", F.col("opens") + 1, F.col("ends") - F.col("opens")).alias("run"),
    )


def _picked(words: DataFrame, probes: DataFrame, window: int) -> DataFrame:
    """(k, th) of the documents in whose words a window's probes stand, with all of the run around them."""
    probes = probes.groupBy("word", "word2", "apart").agg(F.collect_set(F.struct("before", "run")).alias("runs"))
    placed = words.select("k", "th", "words", F.posexplode("words").alias("pos", "raw")).withColumn("word", core(F.col("raw"))).drop("raw")
    hits = placed.join(F.broadcast(probes), "word")
    hits = hits.where(F.col("word2").isNull() | (core(F.get("words", F.col("pos") + F.col("apart"))) == F.col("word2")))
    # only the words that a window around the place can reach leave the join
    first = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    near = F.slice("words", first + 1, F.lit(2 * window - 1))
    hits = hits.select("k", "th", "runs", near.alias("near"), (F.col("pos") - first).alias("at"))
    hits = hits.select("k", "th", "runs", "at", _once(F.transform("near", core)).alias("near"))

    def stands(r: Column) -> Column:
        start = F.col("at") - r.before
        inside = (start >= 0) & (start + F.size(r.run) <= F.size("near"))
        same = F.zip_with(r.run, F.slice("near", F.greatest(start, F.lit(0)) + 1, F.size(r.run)), lambda a, b: a.isNull() | a.eqNullSafe(b))
        return F.when(inside, F.forall(same, lambda x: x)).otherwise(False)

    return hits.select("k", "th", _once(F.exists("runs", stands)).alias("stands")).where("stands").select("k", "th").distinct()


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 8,
    min_share: float = 0.5,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row for each document and item that it leaks: k and th (the row's key), doc_id, item_id, n_windows, share, n_slots, changed.

    ``n_windows`` windows of the item stand in the document, on one alignment and consistent ones at most ``window`` tokens
    away from it, and cover a ``share`` of at least ``min_share`` of the item's tokens; ``n_slots`` different slot values are
    filled, and ``changed`` of them otherwise than in the item.

    Null and empty texts on either side match nothing. An item of fewer than ``window`` tokens is one window. Windows of
    placeholders only cannot be found and don't count, but an item that has no others is found by its values. Items with the
    same item_id are texts of one item and the best counts; equal rows of one doc_id give their leaks once; null ids are kept
    as null. Empty tables give no rows. Other columns are left out.
    """
    spark = docs.sparkSession
    texts = docs.select(*key_of(docs, doc_id, text), F.col(text).alias("text"))
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    items = items.withColumn("item", F.xxhash64("text")).distinct()
    path = scratch_path(spark, "vocabulary")
    vocabulary(texts.select("text").unionByName(items.select("text")).select(_words(F.col("text")).alias("words"))).write.parquet(path)
    known = spark.read.parquet(path)
    path = scratch_path(spark, "templates")
    item_windows(tokens(items, ["item_id", "item"], known), window).write.parquet(path)
    windows = spark.read.parquet(path)
    found = None
    for verbatim, total in windows.groupBy("verbatim").count().collect() or [(False, 0)]:
        blocks = max(1, -(-total // block_windows))
        for block in range(blocks):
            part = windows.where((F.col("verbatim") == verbatim) & (F.pmod(F.xxhash64("wh"), F.lit(blocks)) == block))
            one = _matches(texts, part, known, verbatim, window)
            found = one if found is None else found.unionByName(one)
    path = scratch_path(spark, "leaks")
    found.write.parquet(path)
    found = spark.read.parquet(path).distinct()

    item = ["k", "th", "item_id", "item", "n", "size"]
    slots = F.array_distinct(F.flatten(F.collect_list("slots")))
    lines = found.groupBy(*item, "shift").agg(F.collect_set("start").alias("starts"), slots.alias("slots")).where(_consistent(F.col("slots")))
    lines = lines.groupBy(*item).agg(F.sort_array(F.collect_list(F.struct(F.size("starts").alias("often"), "shift", "starts", "slots")), asc=False).alias("lines"))
    lines = lines.select(*item, "lines", F.explode("lines").alias("line"))
    near = F.filter("lines", lambda x: F.abs(x.shift - F.col("line.shift")) <= window)

    def add(whole: Column, x: Column) -> Column:
        both = F.struct(F.array_union(whole.starts, x.starts).alias("starts"), F.array_union(whole.slots, x.slots).alias("slots"))
        return F.when(_consistent(both.slots), both).otherwise(whole)

    whole = F.aggregate(near, F.struct(F.col("line.starts").alias("starts"), F.col("line.slots").alias("slots")), add)
    added = lines.select(*item, _once(whole).alias("w"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("w.starts", lambda i: F.sequence(i, i + F.col("size") - 1)))))
    added = added.withColumn("share", covered / F.col("n")).where(F.col("share") >= min_share)
    changed = F.size(F.filter("w.slots", lambda s: s.ours != s.theirs)).cast("long")
    best = F.max(F.struct("share", F.size("w.starts").cast("long").alias("n_windows"), F.size("w.slots").cast("long").alias("n_slots"), changed.alias("changed"))).alias("best")
    return added.groupBy("k", "th", "item_id").agg(best).select("k", "th", F.when(F.col("k") != F.lit(-(2**63)), F.col("k")).alias("doc_id"), "item_id", "best.*")


def _consistent(slots: Column) -> Column:
    """Whether no value becomes two, and no two become one."""
    ours = F.size(F.array_distinct(F.transform(slots, lambda s: F.struct(s.kind, s.ours))))
    theirs = F.size(F.array_distinct(F.transform(slots, lambda s: F.struct(s.kind, s.theirs))))
    return (ours == F.size(slots)) & (theirs == F.size(slots))


def _matches(texts: DataFrame, windows: DataFrame, known: DataFrame, verbatim: bool, window: int) -> DataFrame:
    """Where windows of one block stand: (k, th, item_id, item, n, size, start, shift, slots)."""
    probes = _probes(windows, known)
    if verbatim:
        # a token's first word, as it is after a glued unit is cut off
        words = texts.select("k", "th", _words(F.regexp_replace("text", GLUED, "$1 $2")).alias("words"))
        value = F.regexp_replace("word", "^<(num|unit|name)>", "")
        alone = (F.lit(None).cast("string").alias("word2"), F.lit(0).alias("apart"), F.lit(0).alias("before"), F.array().cast("array<string>").alias("run"))
        picked = _picked(words, probes.select(F.substring_index(value, " ", 1).alias("word"), *alone), window)
    else:
        picked = _picked(texts.select("k", "th", _words(F.col("text")).alias("words")), probes, window)
    forms = tokens(texts.join(picked, ["k", "th"], "left_semi"), ["k", "th"], known)
    if verbatim:
        forms = forms.select("k", "th", _once(_verbatim("forms")).alias("forms"))
    placed = forms.select("k", "th", "forms", F.posexplode("forms").alias("pos", "t")).where("t.value IS NULL").withColumn("word", F.col("t.form")).drop("t")
    start = F.col("pos") - F.col("offset")
    hits = placed.join(F.broadcast(probes.drop("before", "run")), "word").where((start >= 0) & (start + F.col("size") <= F.size("forms")))
    hits = hits.where(F.col("word2").isNull() | (F.get("forms", F.col("pos") + F.col("apart")).form == F.col("word2")))
    # the forms are made by a generator, so that the join stays compiled and no row copies its document's tokens
    hits = hits.select("k", "th", "wh", start.alias("at"), _once(F.slice("forms", start + 1, F.col("size"))).alias("forms"))
    hits = hits.where(_hash(F.col("forms")) == F.col("wh"))
    theirs = windows.select("wh", "item_id", "item", "n", "size", "start", F.col("forms").alias("item_forms"))
    pair = F.zip_with("item_forms", "forms", lambda a, b: F.struct(a.form.alias("kind"), a.value.alias("ours"), b.value.alias("theirs")))
    # a template can be that of most items, so the items have no bound: adaptive execution broadcasts them if they are few
    both = hits.join(theirs, "wh").where(F.transform("forms", lambda x: x.form) == F.transform("item_forms", lambda x: x.form))
    return both.select("k", "th", "item_id", "item", "n", "size", "start", (F.col("at") - F.col("start")).alias("shift"), F.filter(pair, lambda s: s.ours.isNotNull()).alias("slots"))
