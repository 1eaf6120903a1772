"""Filters, joins, aggregates and predicates on the small fixtures."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weirflow.functions import predicates as p
from weirflow.functions import udfs
from weirflow.operators import aggregates as agg
from weirflow.operators import features, filters, graph, joins, sets

SENTENCES = [
    "the cow jumped over the moon",
    "the man went to the store and bought some candy",
    "four score and seven years ago",
    "how many apples can you eat",
    "to be or not to be the person",
]


def test_words(spark):
    frame = spark.createDataFrame([(s,) for s in SENTENCES], "sentence string")
    words = filters.words(frame, "sentence")
    counts = {r.word: r.cnt for r in agg.count_by(words, "word").collect()}
    assert words.count() == 36 and len(counts) == 28
    assert {w: c for w, c in counts.items() if c > 1} == {"the": 5, "to": 3, "and": 2, "be": 2}
    assert udfs.python_split(frame, "sentence").count() == 36
    assert agg.two_phase_count(words.withColumn("i", F.rand(1)), "word", "i").where("word = 'the'").first().cnt == 5


def test_transactional_words(spark, rows):
    words = "cat dog chicken cat dog apple cat dog apple banana".split() + ["cat"] * 4 + ["dog"] * 3
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    counts = agg.count_by(frame, "word")
    assert rows(agg.count_histogram(counts, "cnt")) == [(0, 5)]


TWEETERS = {
    "site/1": "sally bob tim george nathan",
    "site/5": "adam david sally nathan",
    "site/123": "tim mike john",
    "site/none": "george",
}
FOLLOWERS = {
    "sally": "bob tim alice adam jim chris jai",
    "bob": "sally nathan jim mary david vivian",
    "tim": "alex",
    "nathan": "sally bob adam harry chris vivian emily jordan",
    "adam": "david carissa",
    "mike": "john bob",
    "john": "alice nathan jim mike bob",
}


def pairs(spark, table, schema):
    return spark.createDataFrame([(k, v) for k, vs in table.items() for v in vs.split()], schema)


def test_reach(spark):
    tweeters = pairs(spark, TWEETERS, "url string, tweeter string")
    followers = pairs(spark, FOLLOWERS, "tweeter string, follower string")
    out = agg.reach(tweeters.unionAll(tweeters), followers, "url", "tweeter", "follower")
    assert {r.url: r.reach for r in out.collect()} == {
        "site/1": 16, "site/5": 14, "site/123": 7, "site/none": 0
    }


def test_single_join(spark, rows):
    gender = spark.createDataFrame([(i, "male" if i % 2 == 0 else "female") for i in range(10)], "id int, gender string")
    age = spark.createDataFrame([(i, i + 20) for i in range(9, -1, -1)], "id int, age int")
    out = rows(joins.single_join([gender, age], ["gender", "age"]))
    assert len(out) == 10 and ("male", 20) in out and ("female", 21) in out
    with pytest.raises(PySparkException, match="twice"):
        joins.single_join([gender.unionAll(gender.where("id = 3")), age], ["gender", "age"]).collect()
    with pytest.raises(PySparkException, match="twice"):
        joins.single_join([gender, age.unionAll(age.where("id = 3"))], ["gender"]).collect()
    with pytest.raises(ValueError):
        joins.single_join([gender, age], ["height"])


def test_percolate_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["the"] * 6 + [f"w{i}" for i in range(8)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=12))) for i in range(60)]
    queries = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 4)))) for i in range(20)] + [(99, "absent the")]
    out = joins.percolate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "q long, text string"), "doc_id", "q"
    )
    want = {(d, q) for d, text in docs for q, ask in queries if set(ask.split()) <= set(text.split())}
    assert {(r.doc_id, r.q) for r in out.collect()} == want and want


def test_update_fields(spark, rows):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, x string, y int")
    changes = spark.createDataFrame([(2, "new", None), (9, "z", 9)], "k int, x string, y int")
    assert rows(joins.update_fields(target, changes, "k", ["x", "y"])) == [(1, "a", 1), (2, "new", 2)]


def test_lookup(spark, rows):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    table = spark.createDataFrame([(1, "x", 0), (1, "y", 0)], "k int, v string, unused int")
    assert rows(joins.lookup(left, table, "k", ["v"])) == [(1, "x"), (1, "y"), (2, None)]
    assert rows(joins.lookup(left, table, "k", ["v"], keep_misses=False)) == [(1, "x"), (1, "y")]


def test_extreme_rows_with_ties(spark, rows):
    vehicles = spark.createDataFrame(
        [(("v1", 90, 20.0), 1), (("v2", 90, 10.0), 2), (("v3", 70, 30.0), 3)],
        "vehicle struct<name string, max_speed int, efficiency double>, driver int",
    )
    fastest = agg.max_row(vehicles, [F.col("vehicle.max_speed"), "driver"]).first()
    thirstiest = agg.min_row(vehicles, [F.col("vehicle.efficiency")]).first()
    assert (fastest.vehicle.name, thirstiest.vehicle.name) == ("v2", "v2")


def test_latest_and_stable_rows(spark, rows):
    frame = spark.createDataFrame([("u", 1, "old"), ("u", 2, "new"), ("w", 1, "only")], "k string, t int, v string")
    assert rows(agg.latest_per_key(frame, ["k"], ["t"]), "k", "v") == [("u", "new"), ("w", "only")]
    assert rows(agg.one_per_key(frame, ["k"], ["t"]), "k", "v") == [("u", "old"), ("w", "only")]


def test_throughput_counts_an_id_once_per_millisecond(spark, rows):
    data = [("2024-01-01 00:00:00.0011", 7), ("2024-01-01 00:00:00.0019", 7), ("2024-01-01 00:00:00.005", 7)]
    frame = spark.createDataFrame(data, "t string, id long").select(F.col("t").cast("timestamp_ntz").alias("ts"), "id")
    assert [r.cnt for r in agg.throughput(frame, "ts", "id", "second").collect()] == [2]
    with pytest.raises(ValueError):
        agg.throughput(frame, "ts", "id", "day")


def test_time_range(spark):
    frame = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,d) AS ts FROM range(5) t(d)")
    assert filters.time_range(frame, "ts", "2024-01-02 00:00:00", "2024-01-04 00:00:00").count() == 2
    assert filters.time_range(frame, "ts", "2024-01-02 00:00:00", period="1 day").count() == 1
    assert filters.time_range(frame, "ts").count() == 5
    with pytest.raises(ValueError):
        filters.time_range(frame, "ts", "2024-01-02", "2024-01-01")


def test_filters(spark, rows):
    frame = spark.createDataFrame([("News",), ("dull",), ("",)], "tag string")
    assert rows(filters.tracked(frame, "tag")) == [("news",)]
    assert filters.containing(frame, "tag", "NONE").count() == 3
    assert filters.non_empty(frame, "tag").count() == 2
    assert rows(filters.equal_ignoring_case(frame, "tag", "NEWS")) == [("News",)]
    assert len(filters.TRACKED_TAGS) == 25


def test_samples_are_repeatable_and_whole(spark):
    frame = spark.range(1000)
    parts = filters.split_by_key(frame, "id", [7, 3])
    sizes = {r.part: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sum(sizes.values()) == 1000 and 600 < sizes[0] < 800
    assert sum(filters.sample_by_key(frame, "id", n).count() for n in (1,)) == filters.sample_by_key(frame, "id").count()
    assert filters.random_sample(frame, 0.1, 3).count() == filters.random_sample(frame, 0.1, 3).count()


def test_observed(spark):
    frame, seen = filters.observed(spark.range(7), "peek")
    frame.collect()
    assert seen.get == {"rows": 7}


def test_spread(spark, tmp_path):
    frame = spark.range(100).withColumn("k", F.lit("hot"))
    assert sets.spread(frame, "shuffle", 3).rdd.getNumPartitions() == 3
    assert sets.spread(frame, "global", 1).rdd.getNumPartitions() == 1
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1000")
    try:
        hot = spark.range(0, 200000, 1, 8).withColumn("k", F.when(F.rand(1) < 2, "hot"))
        sets.spread(hot, "partial_key", 8, ["k"]).write.parquet(f"{tmp_path}/parts")
        assert len(list((tmp_path / "parts").glob("part-*"))) > 1
    finally:
        spark.conf.set(size, before)
    with pytest.raises(ValueError):
        sets.spread(frame, "direct", 1)


def test_predicates(spark):
    frame = spark.range(10)
    i = F.col("id")

    def kept(condition):
        return [r.id for r in frame.where(condition).collect()]

    assert kept(p.xor_(i < 3, i < 5, i == 9)) == [3, 4, 9]
    assert kept(p.and_(i > 2, p.not_(i > 4))) == [3, 4]
    assert kept(p.or_(i == 1, i == 0xD)) == [1]
    assert kept(p.increasing(2, i, 5.5)) == [3, 4, 5]
    assert kept(p.decreasing(5, i, 2)) == [3, 4]
    assert kept(p.all_equal(i, 4, 4.0)) == [4]
    for bad in (p.and_, p.or_, p.xor_, lambda: p.increasing(1)):
        with pytest.raises(ValueError):
            bad()


def test_fold_in_order(spark, rows):
    data = [("a", i, chr(97 + i)) for i in range(20)] + [("b", 1, "z")]
    frame = spark.createDataFrame(data, "k string, n long, v string").repartition(5)
    out = udfs.fold_in_order(frame, ["k"], ["n"], "v", "".join, F.shiftright("n", 2))
    assert rows(out) == [("a", "abcdefghijklmnopqrst"), ("b", "z")]


DAY = 86_400_000


def test_feature_bounds(spark):
    from datetime import datetime, timedelta

    anchor = datetime(2024, 1, 10)

    def use(user, ms, tag="t"):
        return (user, tag, anchor - timedelta(milliseconds=ms))

    uses = [
        use(1, DAY),  # in the label, not in the features
        use(1, 0),  # in neither
        use(1, 4 * DAY),  # in neither, but makes the user eligible
        use(1, DAY + 1),  # in the features
        use(2, DAY + 5), use(2, 2 * DAY), use(2, 1, "other"),
        use(3, 10),  # not eligible
        use(4, 2 * DAY),  # no profile
    ]
    frame = spark.createDataFrame(uses, "user_id long, hashtag string, ts timestamp_ntz")
    relations = spark.createDataFrame([(1, 2), (1, 2), (1, 4), (2, 1), (1, 77)], "user_id long, follower long")
    profiles = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "user_id long, zone string")
    anchors = features.Anchors.daily("2024-01-10 00:00:00", 1)
    out = features.training_rows(frame, relations, profiles, anchors)
    got = {r.user_id: (r.label, r.num_tweets, r.num_user_relations, r.zone) for r in out.where("hashtag = 't'").collect()}
    assert got == {1: (1, 1, 2, "x"), 2: (0, 2, 1, "y")}


def test_scoring_rows(spark):
    from datetime import datetime

    uses = [(1, "t", datetime(2024, 1, 7)), (1, "t", datetime(2024, 1, 7, 0, 0, 1)), (2, "t", datetime(2024, 1, 1))]
    frame = spark.createDataFrame(uses, "user_id long, hashtag string, ts timestamp_ntz")
    relations = spark.createDataFrame([(2, 1)], "user_id long, follower long")
    profiles = spark.createDataFrame([(1,), (2,)], "user_id long")
    out = features.scoring_rows(frame, relations, profiles, "2024-01-10 00:00:00")
    assert {r.user_id: (r.num_tweets, r.num_user_relations) for r in out.collect()} == {1: (1, 0), 2: (0, 1)}


def test_graph(spark, rows):
    uses = spark.createDataFrame([(1, 10), (2, 11)], "u long, e long")
    relations = spark.createDataFrame([(1, 2), (1, 3)], "u long, f long")
    edges = graph.edges(uses, relations, "u", "f", ["e"])
    assert rows(edges) == [("user:1", "use:10", "tweeted"), ("user:1", "user:2", "follows"), ("user:2", "use:11", "tweeted")]
    vertices = graph.vertices(uses, "u", ["e"])
    assert vertices.count() == 4
    out = {r.id: r.neighbours for r in graph.neighbours(edges, "out").collect()}
    assert out == {"user:1": ["use:10", "user:2"], "user:2": ["use:11"]}
    lonely = vertices.unionByName(spark.createDataFrame([("user:9", "user")], "id string, kind string"))
    assert graph.without_isolated(lonely, edges).count() == 4
    assert graph.graph_json(vertices, edges).count() == 7
    with pytest.raises(ValueError):
        graph.neighbours(edges, "both")


def test_followers_counts_meet_where_they_are_added_up(spark, rows):
    rng = random.Random(8)
    counts = [(u, tag, a, rng.randint(1, 5)) for u in range(6) for tag in "xy" for a in range(4) if rng.random() < 0.6]
    relations = [(u, f) for u in range(9) for f in range(8) if rng.random() < 0.5] + [(None, 1), (1, None)]
    want = {}
    for u, f in relations:
        for owner, tag, a, n in counts:
            if owner == f:
                want[u, tag, a] = want.get((u, tag, a), 0) + n
    mine = spark.createDataFrame(counts, "user_id long, tag string, anchor_no long, n long")
    follows = spark.createDataFrame(relations, "user_id long, follower long")
    for held in (10**6, 0):
        found = features.follower_counts(mine, follows, "user_id", "follower", "tag", "n", "total", held)
        assert rows(found) == sorted(((*k, v) for k, v in want.items()), key=repr)
        # the followers' counts travel as lists; nothing is shuffled for each single count
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(user_id" not in plan.split("Generate")[0]


def test_python_split_works_on_bounded_runs(spark, rows, monkeypatch):
    monkeypatch.setattr(udfs, "SPLIT_CHARS", 7)
    texts = [(1, "a  bb c"), (2, None), (None, " x"), (3, ""), (4, "long " * 9), (4, "é\tz y ")]
    frame = spark.createDataFrame(texts, "id long, text string").coalesce(1)
    want = [(i, w) for i, t in texts for w in (t or "").split(" ") if w]
    assert rows(udfs.python_split(frame, "text", ["id"])) == sorted(want, key=repr)
