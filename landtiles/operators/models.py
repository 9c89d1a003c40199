"""Train, apply, save and load classifiers on feature vectors."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landtiles.fixed import LAST_LAYER_L2, LOGISTIC_REGRESSION, RANDOM_FOREST
from landtiles.operators.labels import predict_label

SEED = 20171


def random_forest() -> RandomForestClassifier:
    return RandomForestClassifier(seed=SEED, **RANDOM_FOREST)


def logistic_regression() -> LogisticRegression:
    return LogisticRegression(**LOGISTIC_REGRESSION)


def last_layer() -> LogisticRegression:
    """Softmax layer on frozen features: retraining of the last layer only."""
    return LogisticRegression(family="multinomial", regParam=LAST_LAYER_L2, maxIter=100)


def dense_layers(inputs: int, hidden: int, classes: int) -> MultilayerPerceptronClassifier:
    """Hidden and last layer on frozen features: retraining of the fully connected part."""
    return MultilayerPerceptronClassifier(layers=[inputs, hidden, classes], seed=SEED)


def classifier(kind: str):
    return {"randomforest": random_forest, "logisticregression": logistic_regression}[kind]()


def train_classifier(features: DataFrame, estimator) -> PipelineModel:
    """Fit on ``features, label``; the result adds ``pred_label`` as text.

    Classes are numbered in sorted order. The fit reads its input many times, so hand in
    stored features.
    """
    indexer = StringIndexer(
        inputCol="label", outputCol="label_idx", stringOrderType="alphabetAsc"
    ).fit(features)
    estimator = estimator.copy()
    estimator.setFeaturesCol("vector").setLabelCol("label_idx").setPredictionCol("pred_idx")
    fitted = estimator.fit(indexer.transform(as_vectors(features)).select("vector", "label_idx"))
    names = IndexToString(inputCol="pred_idx", outputCol="pred_label", labels=indexer.labels)
    return PipelineModel(stages=[fitted, names])


def train_dense_layers(features: DataFrame, hidden: int = 64) -> PipelineModel:
    size = features.select(F.size("features").alias("n")).first().n
    classes = features.select("label").distinct().count()
    return train_classifier(features, dense_layers(size, hidden, classes))


def apply_classifier(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Replace ``features`` by ``pred_label``."""
    kept = [c for c in features.columns if c != "features"]
    return model.transform(as_vectors(features)).select(*kept, "pred_label")


def apply_network(scores: DataFrame, index: DataFrame) -> DataFrame:
    """Replace class scores in ``features`` by ``pred_label``, the class that scores highest."""
    return predict_label(scores, "features", index).drop("features")


def as_vectors(features: DataFrame) -> DataFrame:
    return features.withColumn("vector", array_to_vector("features")).drop("features")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def mean_head(features: DataFrame) -> DataFrame:
    """``label, w, b``: a linear head whose weights are the mean features of each class."""
    vectors = as_vectors(features)
    means = vectors.groupBy("label").agg(Summarizer.mean(F.col("vector")).alias("m"))
    return means.select("label", vector_to_array("m").alias("w"), F.lit(0.0).alias("b"))
