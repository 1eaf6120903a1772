"""Timers and state that expires: what the streams emit, and what their state holds afterwards."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from weirflow.streaming import jobs, timed
from weirflow.streaming.sources import table_stream

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


class Fed:
    """A stream that is run again whenever rows have come."""

    def __init__(self, spark, folder, schema, frame, **options):
        self.spark, self.folder, self.schema, self.frame, self.options = spark, str(folder), schema, frame, options

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        stream = table_stream(self.spark, f"{self.folder}/in", self.schema)
        jobs.run_until_empty(self.frame(stream), f"{self.folder}/out", f"{self.folder}/cp", **self.options)
        return self

    def out(self):
        return self.spark.read.parquet(f"{self.folder}/out")

    def keys(self):
        return sorted(r[0][0] for r in timed.state_of(self.spark, f"{self.folder}/cp").select("key").collect())


STORE = "user long, ts timestamp_ntz, seq long, value string"


def store(stream):
    return timed.expiring_store(stream, "user", "ts", "seq", "value", 100, "0 seconds")


def test_an_expired_key_leaves_the_state_and_a_late_write_revives_it(spark, tmp_path):
    fed = Fed(spark, tmp_path, STORE, store).add([(1, at(0), 1, "a"), (2, at(50), 2, "b"), (1, at(60), 3, "c")])
    assert fed.keys() == [1, 2] and fed.out().count() == 0
    fed.add([(3, at(155), 4, "d")])
    # the watermark stands at 155: key 2 ended at 150, key 1 at 160
    assert fed.keys() == [1, 3]
    assert [tuple(r) for r in fed.out().collect()] == [(2, at(50), at(50), 1, 2, "b")]
    fed.add([(3, at(200), 5, "e")])
    assert fed.keys() == [3]
    fed.add([(1, at(210), 6, "again")])
    assert fed.keys() == [1, 3]
    held = timed.held_values(timed.state_of(spark, f"{tmp_path}/cp"), "user", fed.out().schema).orderBy("user")
    assert [tuple(r) for r in held.collect()] == [(1, at(210), at(210), 1, 6, "again"), (3, at(155), at(200), 2, 5, "e")]


def test_a_row_behind_the_watermark_is_dropped(spark, tmp_path):
    fed = Fed(spark, tmp_path, STORE, store).add([(1, at(1000), 1, "a")]).add([(2, at(10), 2, "late")])
    assert fed.keys() == [1]


def test_lives_within_one_batch_and_ties(spark, tmp_path):
    rows = [(1, at(0), 1, "a"), (1, at(0), 2, None), (1, at(99), 3, "b"), (1, at(199), 4, "c"), (None, at(500), 9, None)]
    fed = Fed(spark, tmp_path, STORE, store).add(rows)
    assert fed.keys() == []
    assert sorted(tuple(r) for r in fed.out().collect()) == [(1, at(0), at(99), 3, 3, "b"), (1, at(199), at(199), 1, 4, "c")]


ROLL = "obj string, ts timestamp_ntz"


def rolling(stream, lag="0 seconds"):
    return timed.rolling_emissions(stream, "ts", "obj", 300, 60, lag)


def test_each_run_appends_the_slides_that_are_due(spark, tmp_path):
    fed = Fed(spark, tmp_path, ROLL, rolling).add([("x", at(0)), ("x", at(59)), ("x", at(61))])
    assert [tuple(r) for r in fed.out().collect()] == [("x", 2, at(60))]
    fed.add([("y", at(130))])
    assert sorted(r.cnt for r in fed.out().where("obj = 'x'").collect()) == [2, 3]
    assert fed.keys() == ["x", "y"]
    fed.add([(None, at(10_000))])
    found = fed.out().where("obj = 'x'").orderBy("window_end").collect()
    assert [r.cnt for r in found] == [2, 3, 3, 3, 3, 1, 0]
    assert fed.keys() == []


def test_rolling_matches_brute_force_over_random_batches(spark, tmp_path):
    rng = random.Random(3)
    times = sorted(rng.choice([rng.randint(0, 4000), rng.randint(0, 4000) // 60 * 60]) for _ in range(120))
    rows = [(rng.choice("abc"), at(s)) for s in times]
    # a row at the watermark is late; with a second's lag one that ties with the batch before is not
    fed = Fed(spark, tmp_path, ROLL, lambda s: rolling(s, "1 second"))
    for part in (rows[:30], rows[30:31], rows[31:90], rows[90:]):
        fed.add(part)
    fed.add([(None, at(100_000))])
    panes, want = defaultdict(Counter), []
    for (obj, _), s in zip(rows, times):
        panes[obj][s // 60] += 1
    for obj, counts in panes.items():
        before = 0
        for end in range(1, 100):
            n = sum(counts[p] for p in range(end - 5, end))
            if n or before:
                want.append((obj, n, at(end * 60)))
            before = n
    assert sorted(tuple(r) for r in fed.out().collect()) == sorted(want)
    assert fed.keys() == []
    with pytest.raises(ValueError):
        timed.rolling_emissions(None, "ts", "obj", 60, 60, "0 seconds")


JOIN = "id long, ts timestamp_ntz, side string, value string"


def join(stream):
    return timed.expiring_join(stream, "id", "side", ["a", "b"], "ts", "value", 100, "0 seconds")


def test_join_expires_what_misses_a_side(spark, tmp_path):
    fed = Fed(spark, tmp_path, JOIN, join, by=["status"])
    fed.add([(1, at(0), "a", "a1"), (2, at(10), "b", "b2"), (3, at(20), "a", "a3"), (4, at(30), "a", "a4"), (4, at(31), "b", None)])
    assert fed.keys() == [1, 2, 3]
    fed.add([(1, at(99), "b", "b1"), (2, at(109), "a", "a2"), (3, at(120), "b", "b3")])
    # key 3 came too late: its first side has left, its second waits anew
    assert fed.keys() == [3]
    fed.add([(None, at(1000), None, None)])
    assert fed.keys() == []
    for status, want in (
        ("joined", {(1, "a1", "b1"), (2, "a2", "b2"), (4, "a4", None)}),
        ("expired", {(3, "a3", None), (3, None, "b3")}),
    ):
        assert {(r.id, r.a, r.b) for r in fed.out().where(F.col("status") == status).collect()} == want


def test_a_second_row_of_a_side_is_an_error(spark, tmp_path):
    fed = Fed(spark, tmp_path, JOIN, join, by=["status"])
    with pytest.raises(StreamingQueryException, match="a second row of a"):
        fed.add([(1, at(0), "a", "x"), (1, at(1), "a", "y")])


def test_live_counts_answer_from_the_state(spark, tmp_path):
    folder = str(tmp_path)
    for part in (["a", "b", "a"], ["a", "c"]):
        spark.createDataFrame([(w,) for w in part], "word string").write.mode("append").parquet(f"{folder}/in")
        counted = timed.running_counts(table_stream(spark, f"{folder}/in", "word string"), "word")
        writer = counted.writeStream.format("noop").outputMode("update").option("checkpointLocation", f"{folder}/cp")
        writer.trigger(availableNow=True).start().awaitTermination()
    asked = spark.createDataFrame([("a",), ("zzz",), ("c",), ("a",)], "word string")
    assert sorted(tuple(r) for r in timed.live_counts(asked, f"{folder}/cp", "word").collect()) == [("a", 3), ("c", 1)]


def test_a_waiting_key_holds_one_timer(spark, tmp_path):
    fed = Fed(spark, tmp_path, JOIN, join, by=["status"])
    fed.add([(1, at(0), "a", "a1"), (2, at(10), "b", "b2")]).add([(2, at(20), "a", "a2")])
    held = timed.state_of(spark, f"{tmp_path}/cp").select("value.due").collect()
    assert [r.due for r in held] == [(at(100) - datetime(1970, 1, 1)) // timedelta(milliseconds=1)]


def test_a_join_holds_its_keys_in_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(timed, "BUCKETS", 4)
    fed = Fed(spark, tmp_path, JOIN, join, by=["status"])
    fed.add([(i, at(i % 50), "a", str(i)) for i in range(300)])
    entries = spark.read.format("statestore").option("stateVarName", "state").load(f"{tmp_path}/cp")
    assert entries.count() == 4
    assert fed.keys() == list(range(300))
    held = {r.key.on: (r.value.held, r.value.due) for r in timed.state_of(spark, f"{tmp_path}/cp").collect()}
    micros = (at(49) - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    assert held[49] == (f'[[{micros}, "a", "49"]]', micros // 1000 + 100_000)
    # keys whose time is up leave alone, the others of their bucket stay
    fed.add([(i, at(120), "b", "b") for i in range(30, 300, 50)])
    assert fed.keys() == sorted([i for i in range(300) if i % 50 > 20 and i % 50 != 30])
    assert fed.out().where("status = 'expired'").count() == 21 * 6
    assert fed.out().where("status = 'joined'").count() == 6


def one_by_one(batches, sides, span):
    """The rule of a join, row by row."""
    held, out = {}, []
    for came, watermark in batches:
        keys = defaultdict(list)
        for row in came:
            keys[row[0]].append(row[1:])
        for on in {*keys, *held}:
            now = held.pop(on, [])

            def leave(status):
                found = {s: v for _, s, v in now}
                out.append((on, status, now[0][0], *[found.get(s) for s in sides]))

            for row in sorted(keys[on], key=lambda r: r[:2]):
                if now and row[0] >= now[0][0] + span:
                    leave("expired")
                    now = []
                if row[1] in [s for _, s, _ in now]:
                    raise ValueError(f"a second row of {row[1]} for {on}")
                now = [*now, row]
                if len(now) == len(sides):
                    leave("joined")
                    now = []
            if now and now[0][0] + span <= watermark:
                leave("expired")
            elif now:
                held[on] = now
    return out, held


@pytest.mark.parametrize("seed", range(6))
def test_a_bucket_follows_the_rule_of_each_key(seed):
    rng = random.Random(seed)
    sides, span = ["c", "a", "b"][: 1 + seed % 3], 50
    batches, time = [], 0
    for _ in range(5):
        rows = [(i, time + rng.randint(0, 30), rng.choice(sides), rng.choice([None, "x", "y"])) for i in rng.sample(range(40), 25)]
        # one key with many lives
        rows += [(99, time + 60 * j + 5 * k, s, f"{j}") for j in range(30) for k, s in enumerate(rng.sample(sides, rng.randint(1, len(sides))))]
        time += 60 * 30
        batches.append((rows, time - 45 if seed % 2 else time - 60 * 30 + 10))
    waiting = timed._Waiting(LongType())
    held, out = waiting.schema.empty_table(), []
    for rows, watermark in batches:
        came = list(waiting.came(iter(rows)))
        left, held, due, on = waiting.update(held, came, sides, span, watermark)
        out += [tuple(r.values()) for r in left.to_pylist()]
        if held.num_rows:
            first = {}
            for r in held.to_pylist():
                first.setdefault(r["on"], r["at"])
            assert (due, first[on]) == (min(first.values()) + span, min(first.values()))
    want, rest = one_by_one(batches, sides, span)
    assert sorted(out, key=repr) == sorted(want, key=repr)
    assert [tuple(r.values()) for r in held.to_pylist()] == [(on, *row) for on in dict.fromkeys(held["on"].to_pylist()) for row in rest.pop(on)]
    assert not rest
    if len(sides) > 1:
        with pytest.raises(ValueError, match="a second row of a for 7"):
            waiting.update(held, list(waiting.came(iter([(7, 10**6, "a", None), (7, 10**6 + 1, "a", None)]))), sides, span, 0)
