"""Merkle manifest of a dataset: a digest for every row, a root for every group and one root over all, with proofs.

Rows of a group stand in order and get their place by range, so that no task sees a whole group. A level's node is kept on
the row of its first leaf. Per level, lag and lead columns at fixed offsets, masked by the node's slot in its run and by the
run's length, give a node its siblings; rows of first children hash the parents. Some levels at a time are climbed inside
blocks of consecutive rows, one sort for all of them; the blocks' tops are the nodes of the next table, which is smaller by
``fanout ** levels``. The group roots are climbed in the same way.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.session import scratch_path

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels climbed inside one block: a block is ``fanout ** LEVELS`` rows.
LEVELS = 10
PATH = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """A value as it enters a digest: ``-`` for null, else its size in bytes, a colon and its text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def proof(path: Column) -> Column:
    """The digest of all siblings on a path, from the leaf to the root and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def _written(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _numbered(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``pos``, a node's place in its group from 0, and ``n``, the group's size. Ranges cut a group, and equal rows too."""
    cut = nodes.repartitionByRange(F.col("g"), *order, F.col("salt")).withColumn("range", F.spark_partition_id())
    cut = _written(cut, "manifest-ranges")
    sizes = cut.groupBy("range", "g").agg(F.count("*").alias("size"))
    group = Window.partitionBy("g")
    sizes = sizes.select("range", "g", (F.sum("size").over(group.orderBy("range")) - F.col("size")).alias("first"), F.sum("size").over(group).alias("n"))
    within = F.row_number().over(Window.partitionBy("range", "g").orderBy(*order)) - 1
    placed = cut.withColumn("within", within).join(sizes, ["range", "g"])
    return placed.withColumn("pos", F.col("first") + F.col("within")).drop("range", "first", "within", "salt")


def _subtrees(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Add ``block``, ``top`` (on a block's first row, its digest after ``levels`` levels) and the ``path`` up to there."""
    nodes = nodes.withColumn("block", F.expr(f"pos div {fanout**levels}")).withColumn("top", F.col("digest"))
    block = Window.partitionBy("g", "block").orderBy("pos")
    steps = []
    for level in range(levels):
        step = fanout**level
        slot = F.expr(f"pos div {step}") % fanout
        before = [F.when(slot >= s, F.lag("top", s * step).over(block)).otherwise("") for s in range(fanout - 1, 0, -1)]
        # after the last row of a run there is none to lead to
        after = [F.when(slot + s < fanout, F.coalesce(F.lead("top", s * step).over(block), F.lit(""))).otherwise("") for s in range(1, fanout)]
        nodes = nodes.withColumn("before", F.concat(*before)).withColumn("after", F.concat(*after))
        alive = F.col("n") > step
        siblings = F.when((F.col("pos") % step == 0) & alive, F.struct("before", "after"))
        parent = F.when(alive, F.sha2(F.concat("top", "after"), 256)).otherwise(F.col("top"))
        nodes = nodes.withColumn(f"step{level}", siblings).withColumn("top", F.when(F.col("pos") % (step * fanout) == 0, parent))
        steps.append(f"step{level}")
    upto = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = F.array_compact(F.array(*[F.last(s, ignorenulls=True).over(upto) for s in steps])) if steps else F.array().cast(PATH)
    return nodes.withColumn("path", path).drop("before", "after", *steps)


def _climb(nodes: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """The nodes with their ``path`` to their group's root, and the roots: g and digest."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    height = next(h for h in itertools.count() if fanout**h >= most)
    size = fanout ** min(height, levels)
    lower = _subtrees(nodes, fanout, min(height, levels))
    tops = lower.where(F.col("pos") % size == 0)
    tops = _written(tops.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("digest")), "manifest-tops")
    lower = lower.drop("top")
    if height <= levels:
        return lower.drop("block"), tops.select("g", "digest")
    upper, roots = _climb(tops, fanout, levels)
    upper = upper.select("g", F.col("pos").alias("block"), F.col("path").alias("rest"))
    return lower.join(upper, ["g", "block"]).withColumn("path", F.concat("path", "rest")).drop("block", "rest"), roots


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    fanout: int = 2,
    carried: Mapping[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """Per row of ``docs``: ``order``, leaf, subroot, root, path and the ``carried`` columns.

    A leaf is the digest of the row's ``fields``. The leaves of a group stand by ``order``; every ``fanout`` neighbours, fewer
    at the end, become one parent until one node is left, the group's subroot. Subroots in the order of the groups' names
    (UTF-8, null first) become the root in the same way. ``path`` lists, level by level up to the root, the siblings
    ``before`` and ``after`` a row's node, each as digests put together; see ``proof``, ``folded`` and ``verify``.

    A null in any field is a value of its own, and so is an empty text. Null comes first in the order; rows of one ``order``
    stand by their leaf, and equal rows take neighbouring places, so that the roots do not depend on how rows are split. A
    group of one row has its leaf as subroot; a single group has its subroot as root. An empty table gives no rows. Other
    columns of ``docs`` are left out, whatever their names; ``carried`` must not use g, pos, n, digest or the names above.
    """
    extra = [c.alias(name) for name, c in (carried or {}).items()]
    # null before every name, and before the empty one
    named = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("g")
    digest = leaf([F.col(f"`{c}`") for c in fields]).alias("digest")
    leaves = docs.select(named, F.col(f"`{order}`").alias("at"), digest, *extra, F.monotonically_increasing_id().alias("salt"))
    leaves = _written(leaves, "manifest-leaves")
    placed = _written(_numbered(leaves, [F.col("at").asc_nulls_first(), F.col("digest").asc()]), "manifest-places")
    rows, subroots = _climb(placed, fanout, levels)
    tops = subroots.select(F.lit("").alias("g"), F.col("g").alias("at"), "digest", F.lit(0).alias("salt"))
    groups, root = _climb(_written(_numbered(tops, [F.col("at").asc()]), "manifest-groups"), fanout, levels)
    top = root.first()
    groups = groups.select(F.col("at").alias("g"), F.col("digest").alias("subroot"), F.col("path").alias("rest"))
    # as many rows as groups: Spark broadcasts them if their files are small, else it cuts the hot groups of the join
    return rows.join(_written(groups, "manifest-roots"), "g").select(
        F.col("at").alias(order),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(top.digest if top else None).cast("string").alias("root"),
        F.concat("path", "rest").alias("path"),
        *(carried or {}),
    )


def verify(rows: DataFrame, seen: str) -> DataFrame:
    """Add ``folded_root``, which the leaf in the column ``seen`` gives with the stored siblings, and ``verified``."""
    return rows.withColumn("folded_root", folded(F.col(seen), F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))
