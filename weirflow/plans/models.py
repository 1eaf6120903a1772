"""Training and scoring on the tag-usage features."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import features, filters, models
from weirflow.plans.registry import Tables, query
from weirflow.plans.social import ANCHORED, profiles, relations, uses
from weirflow.session import scratch_path
from weirflow.sources import sinks

TEXT = ("c_mktsegment",)
NUMBERS = ("c_nationkey", "c_acctbal", "num_tweets", "num_user_relations")


def _training(t: Tables):
    rows = features.training_rows(uses(t), relations(t), profiles(t), features.Anchors.covering(uses(t)))
    # a fit reads its input several times
    path = scratch_path(t.spark, "training")
    rows.withColumn("label", F.col("label").cast("double")).write.parquet(path)
    return t.spark.read.parquet(path)


def _split(rows):
    key = rows.withColumn("__key", F.concat_ws(":", "user_id", "hashtag", "anchor"))
    parts = filters.split_by_key(key, "__key", [9, 1]).drop("__key")
    return parts.where("part = 0").drop("part"), parts.where("part = 1").drop("part")


PREDICTED = f"""WITH {ANCHORED} SELECT own.user_id, own.hashtag, own.anchor, CAST(label AS DOUBLE) AS label, true AS scored,
      true AS in_range
    FROM own JOIN profiles USING (user_id) WHERE eligible AND CAST('0x' || left(md5(
      concat_ws(':', own.user_id, own.hashtag, strftime(own.anchor, '%Y-%m-%d %H:%M:%S'))), 8) AS BIGINT) % 10 = 9"""


def _predictions(t: Tables, pipeline):
    """The test part's rows, whether each has a prediction, and whether it lies within the labels seen, as means of labels must."""
    train, test = _split(_training(t))
    scored = models.score(pipeline.fit(train), test)
    bounds = train.agg(F.struct(F.min("label").alias("low"), F.max("label").alias("high"))).scalar()
    given = F.col("prediction").isNotNull() & (F.col("rounded") == F.round("prediction"))
    inside = F.col("prediction").between(bounds.getField("low") - 1e-9, bounds.getField("high") + 1e-9)
    return scored.select("user_id", "hashtag", "anchor", "label", given.alias("scored"), inside.alias("in_range"))


@query(PREDICTED)
def tree_predictions(t):
    return _predictions(t, models.tree_pipeline(TEXT, NUMBERS))


@query(PREDICTED)
def forest_predictions(t):
    return _predictions(t, models.forest_pipeline(TEXT, NUMBERS))


@query("SELECT event_type AS hashtag, count(DISTINCT user_id) AS cnt FROM events JOIN customer ON c_custkey = user_id GROUP BY 1")
def score_all_tags(t):
    """Fit on all anchors, save, load, score every tag in one job, write one folder for each tag, and count its rows."""
    path = scratch_path(t.spark, "model")
    models.save(models.tree_pipeline(TEXT, NUMBERS).fit(_training(t)), path)
    rows = features.scoring_rows(uses(t), relations(t), profiles(t), "2024-01-25 00:00:00")
    scored = models.score(models.load(path), rows)
    out = scratch_path(t.spark, "scores")
    sinks.write_model_output(scored.select("user_id", "hashtag", "prediction", "rounded"), out, [])
    rows = t.spark.read.schema("user_id long, prediction double, rounded double, hashtag string").option("header", True).csv(out)
    return rows.groupBy("hashtag").agg(F.count("prediction").alias("cnt"))


@query(
    """SELECT toxic, round(sqrt(avg(pow(quality - (doc_id % 10) / 10.0, 2))), 9) AS rmse FROM labels GROUP BY 1"""
)
def rmse(t):
    given = t.labels.withColumn("prediction", (F.col("doc_id") % 10) / 10.0)
    measured = models.rmse_rows(given, "quality", "prediction", ["toxic"])
    return measured.select("toxic", F.round("rmse", 9).alias("rmse"))
