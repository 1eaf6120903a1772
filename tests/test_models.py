"""Pipelines on feature rows."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from weirflow.operators import models
from weirflow.sources import readers, sinks


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(3)
    data = []
    for i in range(200):
        n, zone = rng.randint(0, 9), rng.choice(["utc", "cet"])
        data.append((i, "tag" if i % 2 else "other", zone, n, float(n // 3 + (zone == "cet"))))
    return spark.createDataFrame(data, "id long, hashtag string, zone string, num_tweets int, label double")


@pytest.fixture(scope="module")
def fitted(training):
    return models.tree_pipeline(["zone"], ["num_tweets"]).fit(training)


def test_tree_learns_and_is_bounded(fitted, training):
    scored = models.score(fitted, training)
    assert models.rmse(scored, "label", "prediction") < 0.3
    assert fitted.stages[-1].depth <= 5
    assert "If (feature" in models.model_text(fitted)


def test_rmse_as_an_aggregate(fitted, training):
    scored = models.score(fitted, training)
    for column in ("prediction", "rounded"):
        assert models.rmse_rows(scored, "label", column).first().rmse == pytest.approx(models.rmse(scored, "label", column))


def test_save_load_and_score_per_tag(spark, fitted, training, tmp_path):
    models.save(fitted, f"{tmp_path}/model")
    again = models.score(models.load(f"{tmp_path}/model"), training)
    same = models.score(fitted, training).join(again.select("id", F.col("prediction").alias("p2")), "id")
    assert same.where("prediction <> p2").count() == 0
    sinks.write_model_output(again, f"{tmp_path}/out", ["features", "zone_index", "label"])
    assert len(glob.glob(f"{tmp_path}/out/hashtag=*")) == 2


def test_unseen_values_are_kept(spark, fitted):
    row = spark.createDataFrame([(1, "tag", "mars", 3)], "id long, hashtag string, zone string, num_tweets int")
    assert models.score(fitted, row).count() == 1


def test_scoring_a_stream(spark, fitted, training, tmp_path):
    training.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(training.schema).parquet(f"{tmp_path}/in")
    routed = models.score_into_streams(fitted, stream, F.when(F.col("rounded") > 1, "many").otherwise("few"))
    query = (
        routed.select("id", "prediction", "stream").writeStream.format("memory").queryName("scored")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("scored").count() == 200
    assert {r.stream for r in spark.table("scored").collect()} == {"many", "few"}


def test_forest_on_libsvm(spark, tmp_path):
    rng = random.Random(1)
    lines = [f"{rng.choice([0, 1])}.0 1:{i % 4} 2:{rng.random():.3f}" for i in range(60)]
    (tmp_path / "sample.txt").write_text("\n".join(lines) + "\n")
    data = readers.libsvm(spark, f"{tmp_path}/sample.txt", 2)
    train, test = data.randomSplit([0.7, 0.3], seed=5)
    scored = models.vector_forest().fit(train).transform(test)
    assert models.rmse(scored, "label", "prediction") < 1.0


def test_forest_pipeline(training):
    scored = models.score(models.forest_pipeline(["zone"], ["num_tweets"], trees=3).fit(training), training)
    assert scored.where("rounded <> round(prediction)").count() == 0
