"""Tree regression on feature rows with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import FeatureHasher, StringIndexer, VectorIndexer, VectorSlicer
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_DEPTH = 5
FEATURE_BUCKETS = 1 << 18


def indexers(columns: Sequence[str]) -> list[StringIndexer]:
    """Index text columns; values not seen in training get an index of their own."""
    return [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c in columns]


def hashed_features(text: Sequence[str], numbers: Sequence[str], buckets: int = FEATURE_BUCKETS) -> FeatureHasher:
    return FeatureHasher(
        inputCols=[*numbers, *[f"{c}_index" for c in text]], outputCol="hashed", numFeatures=buckets
    )


def used_slots(text: Sequence[str], numbers: Sequence[str]) -> VectorSlicer:
    """Only the slots of the hash space that the columns fall into; the others are 0 in every row and no tree splits on them."""
    hasher = hashed_features(text, numbers)
    ones = SparkSession.active().range(1).select(*[F.lit(1.0).alias(c) for c in hasher.getInputCols()])
    slots = hasher.transform(ones).first().hashed.indices
    return VectorSlicer(inputCol="hashed", outputCol="features", indices=[int(i) for i in slots])


def tree_pipeline(text: Sequence[str], numbers: Sequence[str], label: str = "label", seed: int = 7) -> Pipeline:
    """Indexers, feature hashing and a decision tree."""
    tree = DecisionTreeRegressor(labelCol=label, featuresCol="features", maxDepth=MAX_DEPTH, seed=seed)
    return Pipeline(stages=[*indexers(text), hashed_features(text, numbers), used_slots(text, numbers), tree])


def forest_pipeline(
    text: Sequence[str], numbers: Sequence[str], label: str = "label", trees: int = 20, seed: int = 7
) -> Pipeline:
    forest = RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=trees, seed=seed)
    return Pipeline(stages=[*indexers(text), hashed_features(text, numbers), used_slots(text, numbers), forest])


def vector_forest(features: str = "features", label: str = "label", categories: int = 4, seed: int = 7) -> Pipeline:
    """A forest on ready-made vectors; features with at most ``categories`` values are taken as categories."""
    index = VectorIndexer(inputCol=features, outputCol="indexed", maxCategories=categories, handleInvalid="keep")
    return Pipeline(stages=[index, RandomForestRegressor(labelCol=label, featuresCol="indexed", seed=seed)])


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Predictions, and predictions rounded to whole uses. Works on streams."""
    return model.transform(rows).drop("hashed").withColumn("rounded", F.round("prediction"))


def score_into_streams(model: PipelineModel, rows: DataFrame, stream: Column) -> DataFrame:
    """Predictions with the name of the stream each row goes to."""
    return score(model, rows).withColumn("stream", stream)


def rmse(predictions: DataFrame, label: str, prediction: str) -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse").evaluate(predictions)


def rmse_rows(predictions: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """The same measure as an aggregate, also per key."""
    error = F.col(label) - F.col(prediction)
    return predictions.groupBy(*keys).agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def model_text(model: PipelineModel) -> str:
    """The fitted trees as text."""
    return model.stages[-1].toDebugString


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
