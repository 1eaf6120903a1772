"""Joins. Spark chooses broadcast or shuffle from sizes, and adaptive execution splits skewed keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def resolve_edges(edges: DataFrame, names: DataFrame, src: str, dst: str, key: str, name: str) -> DataFrame:
    """Replace both ends of an edge by looking them up; edges with an unknown end go."""
    ends = names.select(F.col(key).alias("__key"), F.col(name).alias("__name"))
    for end in (src, dst):
        found = ends.withColumnsRenamed({"__key": end, "__name": f"{end}_{name}"})
        edges = edges.join(found, end)
    return edges


def keep_known(df: DataFrame, known: DataFrame, on) -> DataFrame:
    return df.join(known, on, "left_semi")


def drop_blocked(df: DataFrame, blocked: DataFrame, on) -> DataFrame:
    return df.join(blocked, on, "left_anti")


def lookup(df: DataFrame, table: DataFrame, on, columns: Sequence[str], keep_misses: bool = True) -> DataFrame:
    """Enrich rows from a table, reading only the wanted columns. A miss is null, or dropped."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(table.select(*keys, *columns), keys, "left" if keep_misses else "inner")


def single_join(sources: Sequence[DataFrame], output: Sequence[str]) -> DataFrame:
    """Join on the fields all sources share. A key that comes twice on one side is an error.

    Each side is first folded to one row per key, which finds the duplicates without a second pass.
    """
    shared = reduce(lambda a, b: a & b, (set(source.columns) for source in sources))
    if not shared:
        raise ValueError("the sources have no field in common")
    missing = set(output) - set().union(*(source.columns for source in sources))
    if missing:
        raise ValueError(f"no source has the fields {sorted(missing)}")
    keys = sorted(shared)

    def one_per_key(source: DataFrame) -> DataFrame:
        rest = [c for c in source.columns if c not in shared]
        folded = source.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("__n"), *[F.any_value(F.col(c)).alias(c) for c in rest]
        )
        # the check makes a join key, so no later step can prune it away
        checked = F.when(F.col("__n") == 1, F.col(keys[0])).otherwise(
            F.raise_error(F.lit("same side of single join twice")).cast(folded.schema[keys[0]].dataType)
        )
        return folded.withColumn(keys[0], checked).drop("__n")

    return reduce(lambda a, b: a.join(b, keys), map(one_per_key, sources)).select(*output)


def window_join(left: DataFrame, right: DataFrame, on: Sequence[str], ts: str, seconds: int) -> DataFrame:
    """Rows of both sides with equal keys in the same tumbling window."""

    def bucketed(df: DataFrame) -> DataFrame:
        return df.withColumn("window_start", F.window(ts, f"{seconds} seconds").getField("start")).drop(ts)

    return bucketed(left).join(bucketed(right), [*on, "window_start"])


def update_fields(target: DataFrame, changes: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Set the given fields of the rows whose key is matched; a null in the change leaves a field as it is."""
    renamed = changes.select(key, *[F.col(f).alias(f"__new_{f}") for f in fields])
    joined = target.join(renamed, key, "left")
    return joined.withColumns({f: F.coalesce(f"__new_{f}", f) for f in fields}).drop(*[f"__new_{f}" for f in fields])


def percolate(docs: DataFrame, queries: DataFrame, doc_id: str, query_id: str, text: str = "text") -> DataFrame:
    """Match documents to stored queries: one row per document that holds every term of a query.

    A document can match only if it holds the query's rarest term, so documents meet queries on that
    one term, and the common terms, which most documents hold, never produce pairs. The remaining terms
    are tested on the pair.
    """

    def terms(df: DataFrame, key: str) -> DataFrame:
        distinct = F.array_distinct(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""))
        return df.select(key, distinct.alias("terms"))

    doc_terms, query_terms = terms(docs, doc_id), terms(queries, query_id)
    posted = doc_terms.select(doc_id, F.explode("terms").alias("term"))
    asked = query_terms.select(query_id, F.explode("terms").alias("term"))
    frequency = (
        posted.join(asked.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    # a term no document holds counts 0 and so becomes the rarest one: its query matches nothing
    rarest = (
        asked.join(frequency, "term", "left")
        .groupBy(query_id)
        .agg(F.min_by("term", F.struct(F.coalesce("df", F.lit(0)), "term")).alias("term"))
    )
    probes = rarest.join(query_terms.withColumnRenamed("terms", "wanted"), query_id)
    pairs = posted.join(probes, "term").select(doc_id, query_id, "wanted")
    matched = pairs.join(doc_terms, doc_id).where(F.size(F.array_except("wanted", "terms")) == 0)
    return matched.select(doc_id, query_id, F.size("wanted").cast("long").alias("n_terms"))
