"""Streams: restart, replay, late rows and tables."""

import os
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from weirflow.operators.filters import words
from weirflow.streaming import jobs, sources
from weirflow.streaming import tables as st

START = datetime(2024, 1, 1)


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


@pytest.fixture
def table(tmp_path):
    return st.BatchTable(f"{tmp_path}/table", "word string, cnt long", st.sum_by(["word"], ["cnt"]))


def count_words(batch):
    return words(batch, "sentence").groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def state(table, spark):
    return {r.word: r.cnt for r in table.read(spark).collect()}


def feed_sentences(spark, tmp_path, *sentences):
    for s in sentences:
        put(spark, tmp_path / "in", [(s,)], "sentence string")
    return sources.table_stream(spark, str(tmp_path / "in"), "sentence string", files_per_trigger=1)


def test_counts_over_batches_and_restart(spark, tmp_path, table):
    stream = feed_sentences(spark, tmp_path, "the cow", "the man the store")
    jobs.keep_table(stream, table, count_words, f"{tmp_path}/cp", compact_every=1)
    assert len(table.batches(spark)) == 2
    assert state(table, spark) == {"the": 3, "cow": 1, "man": 1, "store": 1}
    stream = feed_sentences(spark, tmp_path, "the end")
    jobs.keep_table(stream, table, count_words, f"{tmp_path}/cp")
    assert state(table, spark)["the"] == 4
    asked = spark.createDataFrame([("cat",), ("the",), ("dog",)], "word string")
    assert [tuple(r) for r in st.query_state(asked, table.read(spark), "word").collect()] == [("the", 4)]


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_failed_batch_is_repeated_without_counting_twice(spark, tmp_path, table, when):
    stream = feed_sentences(spark, tmp_path, "a b", "a c", "a d")
    failures = [1, 2]

    def step(batch, batch_id):
        fail = batch_id in failures
        if fail:
            failures.remove(batch_id)
            if when == "before":
                raise RuntimeError("state update failed")
        table.write(count_words(batch), batch_id)
        if fail:
            raise RuntimeError("lost after the write")

    for _ in range(2):
        with pytest.raises(Exception, match="state update failed|lost after"):
            jobs.drain(stream, step, f"{tmp_path}/cp")
    jobs.drain(stream, step, f"{tmp_path}/cp")
    assert state(table, spark) == {"a": 3, "b": 1, "c": 1, "d": 1}


def test_compaction_keeps_the_state_and_ignores_a_broken_one(spark, tmp_path, table):
    for batch_id in range(4):
        table.write(spark.createDataFrame([("x", 1)], "word string, cnt long"), batch_id)
    assert table.read(spark, before=1).first().cnt == 1
    table.compact(spark, 2)
    assert state(table, spark) == {"x": 4}
    table.compact(spark, 3)
    assert state(table, spark) == {"x": 4}
    # a base whose write did not finish has no success mark
    os.remove(f"{tmp_path}/table/base=3/_SUCCESS")
    assert state(table, spark) == {"x": 4}


def test_needless_folders_go_and_a_repeated_merge_changes_nothing(spark, tmp_path, table):
    for batch_id in range(7):
        table.write(spark.createDataFrame([("x", 1)], "word string, cnt long"), batch_id)
        if batch_id % 2 == 0:
            table.compact(spark, batch_id)
            table.compact(spark, batch_id)
        assert state(table, spark) == {"x": batch_id + 1}
    assert sorted(p.name for p in (tmp_path / "table").iterdir()) == ["base=4", "base=6", "batch=5", "batch=6"]


def test_set_and_upsert(spark, tmp_path, rows):
    both = st.BatchTable(f"{tmp_path}/set", "u long, f long", st.distinct_rows(["u", "f"]))
    for batch_id, pairs in enumerate([[(1, 2), (1, 3)], [(1, 2), (4, 5)]]):
        both.write(spark.createDataFrame(pairs, "u long, f long"), batch_id)
    assert rows(both.read(spark)) == [(1, 2), (1, 3), (4, 5)]
    latest = st.BatchTable(f"{tmp_path}/up", "k long, t long, v string", st.newest_by(["k"], ["t"], ["t", "v"]))
    for batch_id, part in enumerate([[(1, 5, "new"), (2, 1, "x")], [(1, 3, "late"), (2, 1, "tie")]]):
        latest.write(spark.createDataFrame(part, "k long, t long, v string"), batch_id)
    assert rows(latest.read(spark)) == [(1, 5, "new"), (2, 1, "tie")]


def test_ttl(spark, rows):
    frame = spark.createDataFrame([("a", START), ("b", START + timedelta(hours=5))], "k string, at timestamp_ntz")
    assert rows(st.unexpired(frame, "at", "2 hours", "2024-01-01 03:00:00"), "k") == [("b",)]


@pytest.mark.parametrize("every", [1, 50])
def test_running_values_go_on_after_a_restart(spark, tmp_path, rows, every, monkeypatch):
    monkeypatch.setattr(jobs, "COMPACT_EVERY", every)
    table = st.BatchTable(f"{tmp_path}/t", "k string, n long, total long", st.sum_by(["k"], ["n", "total"]))
    for part in ([(0, "a", 1), (1, "b", 5), (2, "a", 2)], [(3, "a", 3), (4, "b", 6)], [(5, "c", 1)]):
        put(spark, tmp_path / "in", part, "seq long, k string, v long")
        stream = sources.table_stream(spark, str(tmp_path / "in"), "seq long, k string, v long")
        jobs.running_values(stream, table, f"{tmp_path}/out", "v", ["seq"], ["k"], f"{tmp_path}/cp")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert rows(out, "seq", "n", "total") == [(0, 1, 1), (1, 1, 5), (2, 2, 3), (3, 3, 6), (4, 2, 11), (5, 1, 1)]


def test_late_rows_are_diverted(spark, tmp_path, rows):
    table = st.BatchTable(f"{tmp_path}/t", "newest timestamp_ntz", jobs.newest_time)
    for seconds in ([10, 3], [8, 4, 20], [14, 16]):
        put(spark, tmp_path / "in", [(START + timedelta(seconds=s), s) for s in seconds], "ts timestamp_ntz, s long")
        stream = sources.table_stream(spark, str(tmp_path / "in"), "ts timestamp_ntz, s long")
        jobs.divert_late(stream, table, f"{tmp_path}/out", f"{tmp_path}/late", "ts", "5 seconds", f"{tmp_path}/cp")
    # the first batch has no watermark; then 10 - 5 and 20 - 5 seconds
    assert rows(spark.read.parquet(f"{tmp_path}/late"), "s") == [(14,), (4,)]
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "s") == [(10,), (16,), (20,), (3,), (8,)]


def test_windows_close_behind_the_watermark(spark, tmp_path, rows):
    schema = "ts timestamp_ntz, k string"
    for seconds in ([1, 2, 4], [7, 2], [30]):
        put(spark, tmp_path / "in", [(START + timedelta(seconds=s), "x") for s in seconds], schema)
        stream = sources.table_stream(spark, str(tmp_path / "in"), schema)
        counts = jobs.windowed_counts(stream, "ts", "6 seconds", "3 seconds", "5 seconds", ["k"])
        jobs.run_until_empty(counts, f"{tmp_path}/out", f"{tmp_path}/cp")
    out = spark.read.parquet(f"{tmp_path}/out")
    got = {(r.window_start - START).total_seconds(): r.cnt for r in out.collect()}
    assert got == {-3.0: 3, 0.0: 4, 3.0: 2, 6.0: 1}


def test_lossy_counting_keeps_its_bound(spark, tmp_path):
    import random

    rng = random.Random(9)
    table = st.BatchTable(f"{tmp_path}/t", "tag string, f long, delta long, seen long", lambda df: df)
    seen, width = [], 20
    for batch_id, size in enumerate((150, 7, 0, 300, 90)):
        tags = [rng.choice(["hot"] * 4 + [f"r{rng.randrange(80)}"]) for _ in range(size)]
        seen += tags
        batch = spark.createDataFrame([(t,) for t in tags], "tag string")
        jobs.lossy_step(table, "tag", width)(batch, batch_id)
    assert table.batches(spark) == [3, 4]
    true, found = Counter(seen), {r.tag: r for r in jobs.lossy_result(table, spark, "tag").collect()}
    for tag, r in found.items():
        assert r.f <= true[tag] <= r.f + r.delta
    assert all(tag in found for tag, n in true.items() if n > len(seen) // width)
    assert len(found) < len(true)


def test_repeated_ids_go(spark, tmp_path, rows):
    put(spark, tmp_path / "in", [(START, 1), (START, 1), (START, 2)], "ts timestamp_ntz, msgid long")
    stream = sources.table_stream(spark, str(tmp_path / "in"), "ts timestamp_ntz, msgid long")
    jobs.run_until_empty(jobs.once_per_id(stream, "ts", "msgid", "5 seconds"), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "msgid") == [(1,), (2,)]


def test_dropped_files(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("one\n")
    (folder / "b.ignore").write_text("not yet\n")
    got = []
    stream = sources.dropped_files(spark, str(folder), archive=str(tmp_path / "done"))
    jobs.drain(stream, lambda batch, _: got.extend(r.value for r in batch.collect()), f"{tmp_path}/cp")
    assert got == ["one"]


def test_snapshots(spark, tmp_path):
    stream = feed_sentences(spark, tmp_path, "x", "y")
    jobs.snapshot_per_batch(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
    assert {r.batch_id: r.sentence for r in spark.read.parquet(f"{tmp_path}/out").collect()} in ({0: "x", 1: "y"}, {0: "y", 1: "x"})


def test_kafka_options():
    options = sources.kafka_options("h:1", topic="t", start="earliest", per_trigger=10)
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "10"
    }
    assert sources.kafka_options("h:1", pattern="a.*", start_ms=5)["startingTimestamp"] == "5"
    for bad in ({}, {"topic": "t", "pattern": "p"}, {"topic": "t", "start": "middle"}):
        with pytest.raises(ValueError):
            sources.kafka_options("h:1", **bad)


def test_message_decoding(spark, rows):
    messages = spark.createDataFrame([("t", 0, 7, bytearray(b'{"a": 1}'))], "topic string, partition int, offset long, value binary")
    assert rows(sources.decode_messages(messages, "a int", metadata=True)) == [(1, "t", 0, 7)]
    assert rows(sources.decode_messages(messages)) == [('{"a": 1}',)]


def test_tick_frequency_must_be_positive(spark):
    for seconds in (-3, 0):
        with pytest.raises(ValueError):
            jobs.tick(None, seconds)


def test_steady_batches(spark, tmp_path):
    stream = sources.rate_numbers(spark, 3)
    sizes = []
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count()))
        .option("checkpointLocation", f"{tmp_path}/cp")
        .start()
    )
    query.awaitTermination(6)
    query.stop()
    assert sizes and set(sizes) == {3}


def test_a_changed_block_list_takes_effect(spark, tmp_path, rows):
    blocked = []
    for part in (["a", "b"], ["a", "b"]):
        stream = feed_sentences(spark, tmp_path, *part)
        jobs.without_blocked(
            stream,
            lambda: spark.createDataFrame([(w,) for w in blocked], "sentence string"),
            "sentence",
            f"{tmp_path}/out",
            f"{tmp_path}/cp",
        )
        blocked.append("a")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert rows(out, "sentence") == [("a",), ("b",), ("b",)]


def test_names_that_share_letters_with_the_suffix(spark, tmp_path):
    from weirflow.streaming.sources import dropped_files

    (tmp_path / "in").mkdir()
    for name in ("table", "june.one", "e", "ore", "x.more", "b.ignore", "a.txt", "c.json", "ignore"):
        (tmp_path / "in" / name).write_text(f"{name}\n")
    jobs.run_until_empty(dropped_files(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp")
    found = {r.value for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert found == {"table", "june.one", "e", "ore", "x.more", "a.txt", "c.json", "ignore"}


def test_a_second_row_of_a_side_is_an_error(spark, tmp_path):
    table = st.BatchTable(f"{tmp_path}/t", "id long, side string, value string", lambda df: df.select("id", "side", "value"))
    rows = spark.createDataFrame([(1, "a", "x"), (1, "a", "y")], "id long, side string, value string")
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    with pytest.raises(Exception, match="a second row of a"):
        jobs.join_sides(stream, table, f"{tmp_path}/out", "id", "side", ["a", "b"], "value", f"{tmp_path}/cp")


def test_state_is_read_for_the_keys_of_the_batch(spark, tmp_path):
    table = st.BatchTable(f"{tmp_path}/t", "k long, n long", st.sum_by(["k"], ["n"]))
    table.write(spark.range(1000).selectExpr("id AS k", "1L AS n"), 0)
    ten = spark.range(10).selectExpr("id AS k")
    state = table.read(spark, only=ten)
    assert state.count() == 10 and "LeftSemi" in state._jdf.queryExecution().toString()
