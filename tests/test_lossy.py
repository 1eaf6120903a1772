"""Lossy counting against the counting rule applied row by row."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weirflow.operators import lossy


def by_rule(tags, width):
    held, bucket, emitted = {}, 1, []
    for n, tag in enumerate(tags, 1):
        f, delta = held.get(tag, (0, bucket - 1))
        held[tag] = (f + 1, delta)
        emitted.append(f + 1 + delta)
        if n % width == 0:
            held = {t: (f, d) for t, (f, d) in held.items() if f + d > bucket}
            bucket += 1
    return emitted, held


def frame_of(spark, tags):
    return spark.createDataFrame([(i, t) for i, t in enumerate(tags, 1)], "n long, tag string")


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(5)
    return [rng.choice(["hot"] * 5 + [f"t{i}" for i in range(10)] + [f"r{rng.randrange(60)}"]) for _ in range(600)]


def test_known_vector(spark):
    out = lossy.lossy_estimates(frame_of(spark, "abacadbaae"), "tag", "n", 5).orderBy("n").collect()
    assert [f"{r.tag}{r.estimate}" for r in out] == "a1 b1 a2 c1 a3 d2 b2 a4 a5 e2".split()
    held = lossy.lossy_count(frame_of(spark, "abacadbaae"), "tag", "n", 5).collect()
    assert [(r.tag, r.f, r.delta) for r in held] == [("a", 5, 0)]


@pytest.mark.parametrize("width", [1, 5, 7, 100])
def test_same_as_the_rule(spark, skewed, width):
    emitted, held = by_rule(skewed, width)
    frame = frame_of(spark, skewed).repartition(4)
    out = lossy.lossy_estimates(frame, "tag", "n", width, block_bits=4).orderBy("n").collect()
    assert [r.estimate for r in out] == emitted
    state = lossy.lossy_count(frame, "tag", "n", width, block_bits=1).collect()
    assert {r.tag: (r.f, r.delta) for r in state} == held


def test_shards_keep_the_bound(spark, skewed):
    width, true = 20, Counter(skewed)
    states, finished = None, []
    for shard in range(3):
        tags = skewed[shard * 200 : shard * 200 + 200]
        state = lossy.lossy_count(frame_of(spark, tags), "tag", "n", width).selectExpr(f"{shard} AS shard", "*")
        states = state if states is None else states.unionByName(state)
        finished.append((shard, 200 // width))
    merged = lossy.merge_shards(states, "tag", spark.createDataFrame(finished, "shard int, buckets long"), "shard")
    found = {r.tag: r for r in merged.collect()}
    assert "hot" in found
    for tag, r in found.items():
        assert r.f <= true[tag] <= r.f + r.delta


def test_exact_heavy_hitters(spark, rows):
    frame = frame_of(spark, "aaaabbbccd")
    assert rows(lossy.heavy_hitters_exact(frame, ["tag"], 0.3)) == [("a", 4), ("b", 3)]


def test_width_must_be_positive(spark):
    with pytest.raises(ValueError):
        lossy.lossy_count(frame_of(spark, "a"), "tag", "n", 0)


def test_blocks_of_any_size_give_the_same(spark):
    rng = random.Random(5)
    frame = frame_of(spark, "".join(rng.choice("aaabbcdefgh") for _ in range(300)))
    want = sorted(tuple(r) for r in lossy.lossy_count(frame, "tag", "n", 7).collect())
    for cuts in ("0", "n div 50", "CASE WHEN n < 3 THEN 0 WHEN n < 120 THEN 4 ELSE 9 END"):
        found = lossy.lossy_count(frame.withColumn("part", F.expr(cuts)), "tag", "n", 7, block="part")
        assert sorted(tuple(r) for r in found.collect()) == want
