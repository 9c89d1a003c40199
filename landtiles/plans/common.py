"""Steps that several jobs share."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landtiles.fixed import CARD_FIELDS, FEATURE_LAYER, SOURCE_CLASSIFIER, SOURCE_NETWORK
from landtiles.operators.featurize import BlockFeatures, OnnxNetwork
from landtiles.operators.metrics import confusion_counts, overall_accuracy
from landtiles.operators.runlog import append_metrics, scalar_metrics, value_metrics
from landtiles.session import cut
from landtiles.sinks.tables import ModelPaths, evened, write_test_predictions
from landtiles.sources.images import (
    read_flat_tiles,
    read_labelled_tiles,
    read_packed_tiles,
)
from landtiles.sources.tables import card_fields, card_rows, read_cards, read_test_predictions


def labelled_tiles(
    spark: SparkSession, root: str, fraction: float, packed: bool, seen: Observation | None = None
) -> DataFrame:
    read = read_packed_tiles if packed else read_labelled_tiles
    return read(spark, root, fraction, seen=seen)


def flat_tiles(
    spark: SparkSession, root: str, fraction: float, packed: bool, seen: Observation | None = None
) -> DataFrame:
    read = read_packed_tiles if packed else read_flat_tiles
    return read(spark, root, fraction, seen=seen)


def feature_extractor(spark: SparkSession, networks: str | None, pretrained: str):
    """The frozen network of this type, or block features where no networks are given."""
    if networks is None:
        return BlockFeatures()
    return OnnxNetwork(spark, f"{networks}/{pretrained}.onnx", FEATURE_LAYER[pretrained])


def stored(features: DataFrame, purpose: str) -> DataFrame:
    """Features written once, so that the passes of a fit do not featurize again."""
    kept = cut(evened(features), purpose)
    if kept.isEmpty():
        raise ValueError("no readable tiles to train on")
    return kept


def model_card(spark: SparkSession, paths: ModelPaths, field_names: dict[str, str] | None = None) -> dict[str, str]:
    """The fields of the model's card; ``field_names`` maps other names of fields to those of this suite."""
    fields = card_fields(read_cards(spark, paths.card).select("value"), [])
    for other, known in (field_names or {}).items():
        fields = fields.withColumn("key", F.when(F.col("key") == other, known).otherwise(F.col("key")))
    return card_rows(fields, [], CARD_FIELDS).first().asDict()


def model_source(card: dict[str, str], source_names: dict[str, str] | None = None) -> str:
    """``classifier`` or ``dnn``; ``source_names`` maps other spellings to these."""
    source = (source_names or {}).get(card["model_source"], card["model_source"])
    if source not in (SOURCE_CLASSIFIER, SOURCE_NETWORK):
        raise ValueError(f"unknown model source {source}")
    return source


def pairs_of(given: list[str]) -> dict[str, str]:
    """``OTHER=KNOWN`` arguments as a dictionary."""
    return dict(pair.split("=", 1) for pair in given)


def record(spark: SparkSession, paths: ModelPaths, run_id: str, **values) -> None:
    append_metrics(scalar_metrics(spark, run_id, values), paths.metrics)


def record_seen(spark: SparkSession, paths: ModelPaths, run_id: str, seen: Observation, prefix: str = "") -> None:
    """What was counted while tiles were read, as ``tiles_read`` and ``tiles_unreadable``."""
    record(spark, paths, run_id, **{f"{prefix}{name}": count for name, count in seen.get.items()})


def record_predicted(written: DataFrame, paths: ModelPaths, run_id: str) -> None:
    """``n_predicted`` per class, with the class as the row's text, from predictions as they were written."""
    counts = written.groupBy("pred_label").count()
    rows = value_metrics(counts, run_id, "n_predicted", "count", text="pred_label")
    append_metrics(rows, paths.metrics)


def evaluate(predictions: DataFrame, paths: ModelPaths, run_id: str) -> DataFrame:
    """Write the predictions of the test set and record how many are right."""
    write_test_predictions(predictions, paths.test_predictions)
    spark = predictions.sparkSession
    written = read_test_predictions(spark, paths.test_predictions)
    result = cut(overall_accuracy(confusion_counts(written)), "accuracy")
    append_metrics(
        value_metrics(result, run_id, "accuracy_on_test_set", "accuracy"), paths.metrics
    )
    record_predicted(written, paths, run_id)
    return result
