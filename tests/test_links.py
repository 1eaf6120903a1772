"""Link graph parsing and scores."""

import pytest

from weirflow.operators import hits as h
from weirflow.sources import readers

LINES = ["1: 2 3 4", "2: 3 4", "3: 1 4", "4: 4"]


@pytest.fixture(scope="module")
def edges(spark):
    return readers.parse_links(spark.createDataFrame([(x,) for x in LINES], "value string"))


@pytest.fixture(scope="module")
def titles(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate("abcd", 1)], "id long, title string")


def test_parse(edges):
    assert edges.count() == 8
    assert edges.where("src = dst").count() == 1


def test_a_line_without_targets_gives_no_link(spark):
    lines = spark.createDataFrame([("5:",), ("6:  ",), (" 7 : 8",), ("9",)], "value string")
    assert [tuple(r) for r in readers.parse_links(lines).collect()] == [(7, 8)]


SCORES = {
    ("hub", 0): [0.096735, 0.156095, 0.285259, 0.461911],
    ("hub", 1): [0.338176, 0.279735, 0.209153, 0.172936],
    ("authority", 0): [0.097561, 0.073171, 0.121951, 0.707317],
    ("authority", 1): [0.278195, 0.255639, 0.248120, 0.218045],
}


@pytest.mark.parametrize("update", ["hub", "authority"])
@pytest.mark.parametrize("every", [1, 3, 10])
def test_scores_after_five_rounds(edges, update, every):
    for which, frame in enumerate(h.hits(edges, 5, update, every)):
        scores = [r.score for r in frame.orderBy("id").collect()]
        assert scores == pytest.approx(SCORES[update, which], abs=1e-6)


def test_dead_vector_gives_an_empty_result(spark):
    bipartite = spark.createDataFrame([(1, 10), (2, 10)], "src long, dst long")
    authorities, hubs = h.hits(bipartite, 5, "authority")
    assert authorities.count() == hubs.count() == 0


def test_bad_arguments(edges):
    with pytest.raises(ValueError):
        h.hits(edges, 0)
    with pytest.raises(ValueError):
        h.hits(edges, 1, "other")


def test_base_set(edges, titles, rows):
    assert rows(h.base_set(edges, titles, "b"), "title", "in_root") == [
        ("a", False), ("b", True), ("c", False), ("d", False)
    ]
    assert rows(h.root_edges(edges, titles, "b")) == [(2, 3), (2, 4)]


def test_titled_edges(edges, titles, rows):
    assert h.titled_edges(edges, titles).count() == 8
    assert rows(h.titled_edges(edges, titles, "a"), "src_title", "dst_title") == [("c", "a")]


def test_top(spark, rows):
    frame = spark.createDataFrame([(1, 0.2), (2, 0.5), (3, 0.2)], "id long, score double")
    assert [r.id for r in h.top_scores(frame, 2).collect()] == [2, 1]
