"""Histograms, zone maps, late rollups, rolled files, aggregates by name, bounded intake and named outputs."""

import json
import os
import random
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from weirflow.functions.aggregates import register_aggregate, weighted_mean
from weirflow.operators import histogram
from weirflow.sources.zones import ZonedLog, merged
from weirflow.streaming import jobs, outputs
from weirflow.streaming import tables as st
from weirflow.streaming.sources import table_stream

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


# --- histograms ---------------------------------------------------------------------------


def test_buckets_are_narrow_and_in_order(spark):
    edges = [0, 1, 2047, 2048, 2049, 4095, 4096, 3_599_999_999, 3_600_000_000] + [2**k + d for k in range(12, 32) for d in (-1, 0, 1)]
    values = sorted({v for v in edges if v <= histogram.BOUND} | {random.Random(1).randint(0, histogram.BOUND) for _ in range(500)})
    frame = spark.createDataFrame([(v,) for v in values], "v long").select("v", histogram.bucket(F.col("v")).alias("b"))
    found = frame.select("v", "b", histogram.highest(F.col("b")).alias("top")).orderBy("v").collect()
    for r in found:
        assert r.v <= r.top <= r.v * (1 + 1 / 1024)
    assert [r.b for r in found] == sorted(r.b for r in found) and found[-1].b < 24_000
    assert all(a.top < b.v for a, b in zip(found, found[1:]) if a.b != b.b)


def test_quantiles_are_close_and_merge(spark):
    rng = random.Random(2)
    values = [int(10 ** rng.uniform(0, 9)) for _ in range(5000)]
    rows = [(i % 3, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame([*rows, (0, None)], "part int, v long").repartition(5)
    parts = histogram.histogram(frame, F.col("v"), ["part"])
    shares = {"p50": 5000, "p99": 9900, "p999": 9990}
    whole = histogram.quantiles(histogram.merged(parts.drop("part")), [], shares).first()
    direct = histogram.quantiles(histogram.histogram(frame, F.col("v")), [], shares).first()
    assert whole == direct and whole.n == 5000
    for name, share in shares.items():
        exact = sorted(values)[-(-len(values) * share // 10_000) - 1]
        assert exact <= whole[name] <= exact * 1.001
    by_part = {r.part: r for r in histogram.quantiles(parts, ["part"], shares).collect()}
    own = sorted(v for p, v in rows if p == 1)
    assert own[(len(own) + 1) // 2 - 1] <= by_part[1].p50 <= own[(len(own) + 1) // 2 - 1] * 1.001


def test_values_outside_the_bound_count_at_its_ends(spark):
    frame = spark.createDataFrame([(-5,), (2**40,), (None,)], "v long")
    assert sorted(r.bucket for r in histogram.histogram(frame, F.col("v")).collect()) == [0, 21 * 1024 + (histogram.BOUND >> 21)]
    assert histogram.quantiles(histogram.histogram(frame.limit(0), F.col("v")), ["bucket"], {"p50": 5000}).count() == 0


# --- zone maps ----------------------------------------------------------------------------


def test_a_range_opens_only_the_files_it_needs(spark, tmp_path):
    log = ZonedLog(str(tmp_path), "ts")
    frame = spark.createDataFrame([(i, at(i * 600)) for i in range(1000)], "id long, ts timestamp_ntz")
    log.write(frame.where("id < 600"), 0, files=12)
    log.write(frame.where("id >= 600"), 1, files=8)
    start, end = (F.lit(at(s)) for s in (300 * 600, 340 * 600))
    found = log.between(spark, start, end)
    assert sorted(r.id for r in found.collect()) == list(range(300, 340))
    opened = {r[0] for r in found.select(F.input_file_name()).distinct().collect()}
    all_files = log.zones(spark).count()
    assert len(opened) <= len(log.files(spark, start, end)) <= 4 < all_files
    assert len(found.inputFiles()) == len(log.files(spark, start, end))
    assert log.between(spark, F.lit(at(-99)), F.lit(at(0))).count() == 0
    # an end is not part of the range, a start is
    assert [r.id for r in log.between(spark, F.lit(at(600)), F.lit(at(1200))).collect()] == [1]


def test_a_run_counts_when_its_zones_are_there_and_can_be_repeated(spark, tmp_path):
    log = ZonedLog(str(tmp_path), "ts")
    frame = spark.createDataFrame([(i, at(i)) for i in range(10)], "id long, ts timestamp_ntz")
    log.write(frame, 0)
    frame.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(f"{tmp_path}/data/run=1")
    everything = F.lit(at(0)), F.lit(at(100))
    assert log.between(spark, *everything).count() == 10
    log.write(frame, 0)
    log.write(frame.where("id < 3"), 1)
    assert log.between(spark, *everything).count() == 13
    other = ZonedLog(f"{tmp_path}/other", "ts")
    other.write(frame, 0)
    both = merged([log, other], spark, F.lit(at(2)), F.lit(at(5)), ["ts", "id"]).collect()
    assert [r.id for r in both] == [2, 2, 2, 3, 3, 4, 4]


# --- rollups and files --------------------------------------------------------------------


def put(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return table_stream(spark, f"{folder}/in", schema)


ROLL = "ts timestamp_ntz, kind string, value long"


def test_rollups_take_late_rows_for_a_time_and_divert_the_rest(spark, tmp_path):
    folder = str(tmp_path)
    newest = st.BatchTable(f"{folder}/newest", "newest timestamp_ntz", jobs.newest_time)

    def run(rows):
        if rows:
            put(spark, folder, rows, ROLL)
        stream = table_stream(spark, f"{folder}/in", ROLL)
        outputs.rollup_late(stream, f"{folder}/out", f"{folder}/late", newest, "ts", ["kind"], "value", "10 minutes", f"{folder}/cp")

    def held():
        rows = outputs.rolled_up(spark.read.parquet(f"{folder}/out"), ["kind"]).collect()
        return {(r.hour, r.kind): (r.cnt, r.total) for r in rows}

    run([(at(0), "a", 1), (at(3599), "a", 2), (at(3600), "b", 5)])
    assert held() == {(at(0), "a"): (2, 3), (at(3600), "b"): (1, 5)}
    # 3601 - 600 s: the first row is in time and its hour is replaced as a whole, the second is late
    run([(at(3000), "a", 10), (at(2999), "a", 100), (at(7200), None, 7)])
    assert held() == {(at(0), "a"): (3, 13), (at(3600), "b"): (1, 5), (at(7200), None): (1, 7)}
    assert [r.value for r in spark.read.parquet(f"{folder}/late").collect()] == [100]
    run([(at(7300), None, 1), (at(3600), "b", 1)])
    assert held()[(at(7200), None)] == (2, 8) and held()[(at(3600), "b")] == (1, 5)
    # the last batch again, as if its commit had been lost: nothing counts twice
    last = max(Path(folder, "cp", "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    os.remove(last)
    os.remove(last.with_name(f".{last.name}.crc"))
    run([])
    assert held()[(at(7200), None)] == (2, 8) and held()[(at(3600), "b")] == (1, 5)


LINE = "seq long, value string"


def test_files_stay_within_their_size_and_move_once(spark, tmp_path):
    folder, rng, seen = str(tmp_path), random.Random(4), []
    lines = [(i, rng.choice("abé") * rng.randint(0, 40)) for i in range(300)] + [(300, None)]
    stream = put(spark, folder, lines, LINE)
    for _ in range(2):
        outputs.rolled_files(stream, "value", ["seq"], f"{folder}/out", 500, f"{folder}/cp{len(seen)}", seen.append)
    files = list(Path(f"{folder}/out/done").rglob("part-*"))
    sizes = [f.stat().st_size for f in files]
    assert max(sizes) <= 500 and len(files) > 10
    got = [line for f in files for line in f.read_text().split("\n")[:-1]]
    assert Counter(got) == Counter(v for _, v in lines if v is not None)
    assert len(seen) == 2 and seen[0] == seen[1] and seen[0].endswith("done/batch=0")
    assert not Path(f"{folder}/out/open/batch=0").exists()


def test_a_line_larger_than_a_file_is_an_error(spark, tmp_path):
    stream = put(spark, str(tmp_path), [(1, "x" * 50)], LINE)
    with pytest.raises(Exception, match="larger than a file"):
        outputs.rolled_files(stream, "value", ["seq"], f"{tmp_path}/out", 50, f"{tmp_path}/cp")


# --- aggregates by name -------------------------------------------------------------------


def test_an_aggregate_is_the_same_whole_and_in_pieces(spark):
    weighted_mean(spark)
    rows = [("hot", i / 7, i % 5 + 1.0) for i in range(500)] + [("one", 3.0, 2.0), ("none", 1.0, 0.0), (None, 2.0, 1.0), ("gap", None, 1.0)]
    spark.createDataFrame(rows, "k string, v double, w double").createOrReplaceTempView("pieces")
    whole = spark.sql("SELECT k, weighted_mean(v, w) AS m FROM pieces GROUP BY k").collect()
    parts = "SELECT k, weighted_mean_part(v, w) AS part FROM pieces GROUP BY k, pmod(hash(v), 9)"
    pieced = spark.sql(f"SELECT k, weighted_mean_total(part) AS m FROM ({parts}) GROUP BY k").collect()
    want = sum(v * w for k, v, w in rows if k == "hot") / sum(w for k, _, w in rows if k == "hot")
    for got in (whole, pieced):
        found = {r.k: r.m for r in got}
        assert found["hot"] == pytest.approx(want) and found["one"] == 3.0 and found[None] == 2.0
        assert found["none"] is None and found["gap"] is None


def test_states_can_be_any_json(spark):
    def add(state, words):
        return sorted(set(state) | set(words.dropna()))

    register_aggregate(spark, "listed", "string", list, add, lambda a, b: sorted(set(a) | set(b)), json.dumps)
    spark.createDataFrame([(i % 2, w) for i, w in enumerate("b a c a b d".split())], "k int, w string").createOrReplaceTempView("listed_rows")
    out = spark.sql("SELECT listed_total(p) AS all FROM (SELECT listed_part(w) AS p FROM listed_rows GROUP BY k)").first()
    assert json.loads(out["all"]) == ["a", "b", "c", "d"] == json.loads(spark.sql("SELECT listed(w) FROM listed_rows").first()[0])


# --- intake and named outputs -------------------------------------------------------------


def test_batches_stay_within_the_bound(spark, tmp_path):
    spark.range(0, 100, 1, 10).write.parquet(f"{tmp_path}/in")
    for options, batches, most in (({"files_per_trigger": 4}, 3, 40), ({"bytes_per_trigger": 1}, 10, 10), ({}, 1, 100)):
        stream = table_stream(spark, f"{tmp_path}/in", "id long", **options)
        sizes = jobs.batch_sizes(jobs.drain(stream, lambda batch, n: batch.count(), f"{tmp_path}/cp{batches}"))
        assert [b for b, _, _ in sizes] == list(range(batches))
        assert sum(n for _, n, _ in sizes) == 100 and max(n for _, n, _ in sizes) <= most and all(ms >= 0 for _, _, ms in sizes)


def test_named_outputs_hold_each_batch_once_after_a_failure(spark, tmp_path):
    spark.range(30).write.parquet(f"{tmp_path}/in")
    name = F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b")
    folders = {s: outputs.batch_folder(f"{tmp_path}/{s}") for s in "ab"}

    def away(rows, batch_id):
        raise RuntimeError("an output is away")

    def run(targets):
        outputs.fan_out(table_stream(spark, f"{tmp_path}/in", "id long"), name, targets, f"{tmp_path}/cp")

    with pytest.raises(Exception, match="an output is away"):
        run(folders | {"b": away})
    run(folders)
    spark.range(30, 36).write.mode("append").parquet(f"{tmp_path}/in")
    run(folders)
    for i, s in enumerate("ab"):
        assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/{s}").collect()) == list(range(i, 36, 3))
