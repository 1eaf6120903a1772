"""Rolling counts and rankings."""

from datetime import datetime, timedelta

import pytest

from weirflow.operators import windows

START = datetime(2024, 1, 1)


def test_rolling_count_rises_falls_and_closes_with_one_zero(spark):
    # one row in each of the first four minutes; five slots
    data = [(START + timedelta(minutes=m, seconds=10), "x") for m in range(4)] + [(START + timedelta(minutes=30), "y")]
    frame = spark.createDataFrame(data, "ts timestamp_ntz, obj string")
    out = windows.rolling_count(frame, "ts", "obj", 300, 60).where("obj = 'x'").orderBy("window_end").collect()
    assert [r.cnt for r in out] == [1, 2, 3, 4, 4, 3, 2, 1, 0]
    assert [r.window_seconds for r in out] == [60, 120, 180, 240, 300, 300, 300, 300, 300]
    assert out[0].window_end == START + timedelta(minutes=1)


def test_rolling_count_needs_two_slots(spark):
    frame = spark.createDataFrame([(START, "x")], "ts timestamp_ntz, obj string")
    for length, emit in ((60, 60), (30, 60), (60, 0)):
        with pytest.raises(ValueError):
            windows.rolling_count(frame, "ts", "obj", length, emit)


def test_a_gap_gives_a_zero_and_the_object_comes_back(spark):
    data = [(START, "x"), (START + timedelta(minutes=9), "x")]
    frame = spark.createDataFrame(data, "ts timestamp_ntz, obj string")
    out = windows.rolling_count(frame, "ts", "obj", 180, 60).orderBy("window_end").collect()
    assert [r.cnt for r in out] == [1, 1, 1, 0, 1, 1, 1, 0]


def test_sliding_time_windows_before_1970(spark, rows):
    frame = spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 58),)], "ts timestamp_ntz")
    out = windows.sliding_time_count(frame, "ts", 6, 3)
    ends = [datetime(1970, 1, 1), datetime(1970, 1, 1, 0, 0, 3)]
    assert sorted(r.window_end for r in out.collect()) == ends


@pytest.mark.parametrize("n", [-10, -3, -2, -1, 0])
def test_illegal_ranking_size(spark, n):
    frame = spark.createDataFrame([("a", 1)], "obj string, cnt long")
    with pytest.raises(ValueError):
        windows.top_n(frame, n, "cnt", "obj")
    with pytest.raises(ValueError):
        windows.top_n_per(frame, n, "cnt", "obj", [])


@pytest.mark.parametrize("n", [1, 2, 3, 20])
def test_ranking(spark, rows, n):
    data = [("a", 3, "x"), ("b", 5, "y"), ("c", 3, "z"), ("gone", 0, "-")]
    frame = spark.createDataFrame(data, "obj string, cnt long, extra string")
    want = [(1, "b", "y"), (2, "a", "x"), (3, "c", "z")][:n]
    assert rows(windows.top_n(frame, n, "cnt", "obj", ["extra"]), "rank", "obj", "extra") == want


def test_flush_lists_the_last_value_of_each_key(spark):
    data = [(0, "a", 9, 1), (1, "a", 2, 2), (2, "b", 5, 3), (20, "c", 1, 4)]
    frame = spark.createDataFrame(
        [(START + timedelta(seconds=s), k, v, i) for s, k, v, i in data], "ts timestamp_ntz, k string, v long, i long"
    )
    ranked = windows.top_k_flush(frame, "ts", "k", "v", "i", 10)
    lines = sorted(r.value for r in windows.flush_lines(ranked, "k").collect())
    assert lines == ["<2024-01-01 00:00:00><b><a>", "<2024-01-01 00:00:20><c>"]
