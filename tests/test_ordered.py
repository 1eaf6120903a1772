"""Running values against a loop, with blocks small enough that every key spans many."""

import random

import pytest
from pyspark.sql import functions as F

from weirflow.operators import ordered, windows
from weirflow.operators.aggregates import chunked_lists, exact_percentiles
from weirflow.operators.ordered import Fold, integral_block, prefix


@pytest.fixture(scope="module")
def data():
    rng = random.Random(1)
    # a third of the rows belong to one key, some to no key
    keys = ["hot", "hot", "a", "b", None, "c"]
    return [(i * 3, rng.choice(keys), rng.choice([None, 1, 2, 7])) for i in range(400)]


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(random.Random(2).sample(data, len(data)), "seq long, k string, v long").repartition(5)


def expected(data, inclusive=True):
    state, out = {}, {}
    for seq, key, value in data:
        total, largest, last = before = state.get(key, (None, None, None))
        if value is not None:
            total = value if total is None else total + value
            largest = value if largest is None else max(largest, value)
            last = value
        state[key] = (total, largest, last)
        out[seq] = state[key] if inclusive else before
    return out


@pytest.mark.parametrize("inclusive", [True, False])
def test_prefix_matches_a_loop(frame, data, inclusive):
    folds = {name: Fold(kind, F.col("v")) for name, kind in (("t", "sum"), ("m", "max"), ("l", "last"))}
    out = prefix(frame, ["seq"], folds, ["k"], integral_block("seq", 4), inclusive)
    assert out.columns == ["seq", "k", "v", "t", "m", "l"]
    assert {r.seq: (r.t, r.m, r.l) for r in out.collect()} == expected(data, inclusive)


def test_prefix_without_a_key(frame, data):
    out = ordered.row_index(frame, ["seq"], block=integral_block("seq", 5))
    assert {r.seq: r.row_no for r in out.collect()} == {d[0]: i + 1 for i, d in enumerate(data)}


def test_unknown_fold(frame):
    with pytest.raises(ValueError):
        prefix(frame, ["seq"], {"x": Fold("median", F.col("v"))})


def test_range_blocks_order_ties_by_later_columns(spark):
    data = [(7 if i % 3 else i, i) for i in range(300)]
    frame = ordered.range_blocks(spark.createDataFrame(data, "t long, i long"), ["t", "i"], 6)
    assert frame.select("block").distinct().count() > 1
    out = ordered.row_index(frame, ["t", "i"], block=F.col("block"))
    assert [r.i for r in out.orderBy("row_no").collect()] == [i for _, i in sorted(data)]


def test_running_sum_of_running_sums(spark):
    frame = spark.createDataFrame([(i, i) for i in range(1, 6)], "seq long, value long")
    out = ordered.chained_running_sum(frame, "value", ["seq"], block=integral_block("seq", 1)).orderBy("seq")
    assert [(r.running, r.running2) for r in out.collect()] == [(1, 1), (3, 4), (6, 10), (10, 20), (15, 35)]


def test_order_violations(spark, rows):
    data = [(0, 1, 0), (1, 1, 1), (2, 2, 0), (3, 1, 3), (4, 2, 0), (5, 2, 1), (6, 3, 5)]
    frame = spark.createDataFrame(data, "at long, c1 int, c2 int")
    bad = ordered.order_violations(frame, "c2", ["at"], ["c1"], integral_block("at", 1))
    assert rows(bad, "c1", "c2", "expected") == [(1, 3, 2), (2, 0, 1), (3, 5, 0)]


def test_sliding_count_windows_against_a_loop(spark, rows):
    values = list(range(1, 48))
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "seq long, v long")
    for length, slide in ((30, 10), (5, 3), (4, 6), (3, 3)):
        ends = range(slide, len(values) + 1, slide)
        want = [(n + 1, sum(values[max(0, e - length) : e])) for n, e in enumerate(ends)]
        got = windows.sliding_count_sum(frame, "v", length, slide, ["seq"], block=integral_block("seq", 2))
        assert rows(got, "window_no", "window_sum") == sorted(want, key=repr)


def test_tumbling_count_drops_the_rest(spark, rows):
    frame = spark.createDataFrame([(i, 1) for i in range(8)], "seq long, v long")
    got = windows.tumbling_count(frame, 3, ["seq"], [F.sum("v").alias("s")])
    assert rows(got, "window_no", "s") == [(0, 3), (1, 3)]


def test_window_sum_is_added_to_the_total_each_time(spark, rows):
    values = [1, 2, 3, 4, 5, 6, 7, 8, 9]
    frame = spark.createDataFrame(list(enumerate(values)), "seq long, v long")
    got = windows.accumulated_window_sum(frame, "v", 5, 3, ["seq"])
    # windows 1..3, 2..6, 5..9
    assert rows(got, "window_no", "total") == [(1, 6), (2, 26), (3, 61)]


def test_average_is_a_whole_number(spark, rows):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate([1, 2, 4])], "seq long, v long")
    assert rows(windows.sum_then_average(frame, "v", 1, 1, 3, ["seq"]), "window_avg") == [(2,)]


def test_chunked_lists_keep_every_value(spark):
    data = [("hot", i) for i in range(105)] + [("cold", 3)]
    lists = chunked_lists(spark.createDataFrame(data, "k string, v long"), ["k"], "v", 10, integral_block("v", 3)).collect()
    assert max(len(r.items) for r in lists) == 10
    hot = sorted((r.chunk_no, r["items"]) for r in lists if r.k == "hot")
    assert [v for _, chunk in hot for v in chunk] == list(range(105))


def test_exact_percentiles(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    groups = {"a": rng.lognormal(3, 2, 500).round(2), "b": np.array([-5.0, 0.0, 0.0, 12.5]), "c": np.array([4.0])}
    data = [(k, float(v)) for k, vs in groups.items() for v in vs]
    out = exact_percentiles(spark.createDataFrame(data, "k string, v double"), ["k"], "v", [0.5, 0.99, 0.999, 0.0, 1.0])
    for r in out.collect():
        want = np.percentile(groups[r.k], [50, 99, 99.9, 0, 100])
        assert [r.p0, r.p1, r.p2, r.p3, r.p4] == pytest.approx(list(want))


@pytest.mark.parametrize(
    "order",
    [
        "concat('https://www.example.org/', id)",
        "1700000000000 + id",
        "xxhash64(id)",
        "id / 100000",
        "concat('user:', lpad(id, 9, '0'))",
    ],
)
def test_blocks_follow_the_rows(spark, order):
    """A key with a third of the rows is cut, whatever the order values look like, and no block is far above the mean."""
    frame = spark.range(12000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", f"{order} AS o")
    sizes = [r["count"] for r in ordered.range_blocks(frame, ["k", "o"], 12).groupBy("block").count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 2 * 12000 / 12
    numbered = ordered.row_index(frame, ["o"], ["k"])
    want = frame.groupBy("k").count()
    got = numbered.groupBy("k").agg({"row_no": "max"}).withColumnRenamed("max(row_no)", "count")
    assert want.exceptAll(got.select("k", "count")).count() == 0
