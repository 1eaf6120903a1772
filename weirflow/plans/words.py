"""Word queries over the texts of ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.functions.udfs import python_split as split_in_python
from weirflow.functions.udfs import SplitWords, exclaim, register_scalar, register_table_function
from weirflow.operators import aggregates as agg
from weirflow.operators import filters, lossy, windows
from weirflow.operators.ordered import Fold, prefix
from weirflow.plans.registry import Tables, query
from weirflow.session import scratch_path

WORDS = r"""words AS (
  SELECT doc_id, word FROM (
    SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents)
  WHERE word <> '')"""
COUNTS = f"{WORDS}, counts AS (SELECT word, count(*) AS cnt FROM words GROUP BY word)"


def _words(t: Tables, *keep: str):
    return filters.words(t.documents, "text", keep=keep)


def _counts(t: Tables):
    return agg.count_by(_words(t), "word")


@query(f"WITH {COUNTS} SELECT word, cnt FROM counts")
def word_count(t):
    return _counts(t)


@query(f"WITH {WORDS} SELECT doc_id, word FROM words")
def flatmap_words(t):
    return _words(t, "doc_id")


@query(f"WITH {WORDS} SELECT word, count(*) AS cnt FROM words GROUP BY word")
def skew_two_phase(t):
    # the text itself is the salt, so the copies of a frequent word in different texts are counted apart
    return agg.two_phase_count(_words(t, "doc_id"), "word", "doc_id")


@query(
    f"""WITH {COUNTS} SELECT word, cnt, row_number() OVER (ORDER BY cnt DESC, word) AS rank
    FROM counts ORDER BY cnt DESC, word LIMIT 20"""
)
def topn_words(t):
    return windows.top_n(_counts(t), 20, "cnt", "word")


@query(f"WITH {COUNTS} SELECT word, cnt FROM counts WHERE cnt >= (SELECT count(*) FROM words) * 0.005")
def heavy_hitters_exact(t):
    return lossy.heavy_hitters_exact(_words(t), ["word"], 0.005)


@query(f"WITH {COUNTS} SELECT cnt // 10 AS bucket, count(*) AS n_keys FROM counts GROUP BY 1")
def count_histogram(t):
    return agg.count_histogram(_counts(t), "cnt")


def _asked(t: Tables):
    """A request: the words of the benchmark items."""
    return filters.words(t.benchmark, "text").distinct()


ASKED = r"""asked AS (
  SELECT DISTINCT word FROM (
    SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM benchmark) WHERE word <> '')"""


@query(f"WITH {COUNTS}, {ASKED} SELECT word, cnt FROM asked JOIN counts USING (word)")
def state_query(t):
    return _asked(t).join(_counts(t), "word")


@query(f"WITH {COUNTS}, {ASKED} SELECT CAST(sum(cnt) AS BIGINT) AS total FROM asked JOIN counts USING (word)")
def state_query_sum(t):
    return _asked(t).join(_counts(t), "word").agg(F.sum("cnt").alias("total"))


SPACES = """SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
  WHERE word <> '' GROUP BY word"""


@query(SPACES)
def udtf_split(t):
    register_table_function(t.spark, "split_words", SplitWords)
    t.documents.select("text").createOrReplaceTempView("weirflow_documents")
    return t.spark.sql("SELECT word, count(*) AS cnt FROM weirflow_documents, LATERAL split_words(text) GROUP BY word")


@query(SPACES)
def python_split(t):
    return agg.count_by(split_in_python(t.documents, "text"), "word")


@query("SELECT c_custkey, c_name || '!!!' AS exclaimed FROM customer")
def udf_scalar(t):
    register_scalar(t.spark, "exclaim", "string", exclaim)
    t.customer.createOrReplaceTempView("weirflow_customer")
    return t.spark.sql("SELECT c_custkey, exclaim(c_name) AS exclaimed FROM weirflow_customer")


POSITIONED = r"""indexed AS (SELECT word, row_number() OVER (ORDER BY doc_id, pos) AS n FROM (
  SELECT doc_id, word, pos FROM (
    SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM (
      SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '') AS ws FROM documents)))),
rated AS (SELECT word, n, (n - 1) // 100 + 1 AS b, row_number() OVER (PARTITION BY word ORDER BY n) AS c FROM indexed),
estimated AS (SELECT word, n, b, c, c + max(b - c) OVER (PARTITION BY word ORDER BY n) AS e FROM rated)"""


#: Words of a block, as a power of two: many more than a text has, and few enough that there are blocks for all tasks.
BLOCK_BITS = 19


def _indexed_words(t: Tables):
    """All words in order of text and position, numbered from 1, and their number.

    Only the word counts of the texts are added up along the order; the words then get the opening number
    of their text plus their position. The texts are dealt by ``block``, which counts up along them, so that the words of
    neighbouring texts lie in one task.
    """
    kept = F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w != "")
    texts = t.documents.select("doc_id", "text")
    path = scratch_path(t.spark, "sizes")
    texts.select("doc_id", F.size(kept).cast("long").alias("n_words")).write.parquet(path)  # read several times
    sizes = t.spark.read.parquet(path)
    upto = prefix(sizes, ["doc_id"], {"upto": Fold("sum", F.col("n_words"))})
    opening = upto.select("doc_id", (F.col("upto") - F.col("n_words")).alias("opening"))
    opened = texts.join(opening, "doc_id").select("text", "opening", F.shiftright("opening", BLOCK_BITS).alias("block"))
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    words = filters.positioned_words(opened.repartition(tasks, "block"), "text", ["opening", "block"])
    numbered = words.select("word", (F.col("opening") + F.col("pos")).alias("n"), "block")
    return numbered, sizes.agg(F.sum("n_words").alias("n"))


@query(
    f"""WITH {POSITIONED}, entered AS (SELECT *, (lag(e) OVER (PARTITION BY word ORDER BY n) IS NULL OR lag(e) OVER (PARTITION BY word ORDER BY n) <= b - 1)
        AS entering FROM estimated)
    SELECT word, CAST(max(e) - max(b - 1) FILTER (entering) AS BIGINT) AS f,
      CAST(max(b - 1) FILTER (entering) AS BIGINT) AS delta, CAST(max(e) AS BIGINT) AS estimate
    FROM entered GROUP BY word HAVING max(e) > (SELECT max(n) FROM indexed) // 100"""
)
def lossy_count(t):
    numbered, total = _indexed_words(t)
    return lossy.lossy_count(numbered, "word", "n", 100, total, block="block")


@query(
    """WITH rated AS (SELECT event_id, event_type, event_id // 100 + 1 AS b,
         row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS c FROM events)
    SELECT event_id, event_type, CAST(c + max(b - c) OVER (PARTITION BY event_type ORDER BY event_id) AS BIGINT)
      AS estimate FROM rated"""
)
def lossy_estimates(t):
    numbered = t.events.select("event_type", "event_id", (F.col("event_id") + 1).alias("n"))
    return lossy.lossy_estimates(numbered, "event_type", "n", 100).select("event_id", "event_type", "estimate")


PERCOLATE = r"""
WITH d AS (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '\s+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_split_to_array(lower(text), '\s+')) AS term FROM benchmark),
n AS (SELECT item_id, count(*) AS n_terms FROM q WHERE term <> '' GROUP BY item_id)
SELECT doc_id, item_id, n_terms FROM (
  SELECT d.doc_id, q.item_id, count(*) AS hits FROM d JOIN q USING (term) WHERE term <> '' GROUP BY ALL)
JOIN n USING (item_id) WHERE hits = n_terms"""


@query(PERCOLATE)
def percolate(t):
    from weirflow.operators.joins import percolate as match

    return match(t.documents, t.benchmark, "doc_id", "item_id")


@query("SELECT doc_id, lang FROM documents WHERE length(text) > 0")
def filter_nonempty(t):
    return filters.non_empty(t.documents, "text").select("doc_id", "lang")


@query("SELECT conv_id, turn, upper(role) AS role FROM conversations")
def map_upper(t):
    return t.conversations.select("conv_id", "turn", F.upper("role").alias("role"))


@query("SELECT doc_id, source || '!!!' || '!!!' AS source FROM documents")
def append_suffix(t):
    once = t.documents.select("doc_id", F.concat("source", F.lit("!!!")).alias("source"))
    return once.withColumn("source", F.concat("source", F.lit("!!!")))
