"""Job: train a classifier on frozen features, test it, save it."""

import argparse
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession

from landtiles.fixed import CLASSIFIER_TYPES, FEATURE_LAYER, SOURCE_CLASSIFIER, TILE_SIDE
from landtiles.operators.featurize import featurize
from landtiles.operators.models import apply_classifier, classifier, save_model, train_classifier
from landtiles.plans.checks import check_classifier, check_fraction, check_pretrained
from landtiles.plans.common import (
    evaluate,
    feature_extractor,
    labelled_tiles,
    record,
    record_seen,
    stored,
)
from landtiles.session import job_session, tile_job
from landtiles.sinks.tables import ModelPaths, write_card


@tile_job
def train(
    spark: SparkSession,
    train_root: str,
    test_root: str,
    paths: ModelPaths,
    pretrained: str,
    kind: str,
    fraction: float = 1.0,
    networks: str | None = None,
    side: int = TILE_SIDE,
    packed: bool = False,
) -> DataFrame:
    """Returns one row ``n_total, n_correct, accuracy`` of the test set."""
    check_pretrained(pretrained)
    check_classifier(kind)
    check_fraction(fraction)
    extractor = feature_extractor(spark, networks, pretrained)
    seen, seen_test = Observation("training"), Observation("testing")
    training = labelled_tiles(spark, train_root, fraction, packed, seen)
    testing = labelled_tiles(spark, test_root, fraction, packed, seen_test)

    write_card(
        spark,
        paths.card,
        {
            "output_model_name": paths.name,
            "model_source": SOURCE_CLASSIFIER,
            "pretrained_model_type": pretrained,
            "retraining_type": "last_only",
            "classifier_type": kind,
        },
    )
    run_id = uuid.uuid4().hex
    record(
        spark, paths, run_id,
        pretrained_model_type=pretrained, classifier_type=kind,
        output_model_name=paths.name, sample_frac=fraction,
    )
    model = train_classifier(
        stored(featurize(training, extractor, side), "train-features"), classifier(kind)
    )
    record_seen(spark, paths, run_id, seen)
    save_model(model, paths.classifier)
    predictions = apply_classifier(model, featurize(testing, extractor, side))
    result = evaluate(predictions, paths, run_id)
    record_seen(spark, paths, run_id, seen_test, "test_")
    return result


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--train-root", required=True, help="folder with one folder per class")
    parser.add_argument("--test-root", required=True, help="held-out folder of the same shape")
    parser.add_argument("--models", required=True, help="folder for models and their cards")
    parser.add_argument("--results", required=True, help="folder for predictions and metrics")
    parser.add_argument("--networks", help="folder with <pretrained type>.onnx files")
    parser.add_argument("-p", "--pretrained", required=True, choices=tuple(FEATURE_LAYER))
    parser.add_argument("-m", "--classifier", required=True, choices=CLASSIFIER_TYPES)
    parser.add_argument("-o", "--name", required=True, help="name of the model")
    parser.add_argument("-f", "--fraction", type=float, default=1.0, help="share of tiles to use")
    parser.add_argument("--packed", action="store_true", help="roots are tables of packed tiles")
    args = parser.parse_args(argv)
    check_fraction(args.fraction)
    train(
        job_session("train"), args.train_root, args.test_root,
        ModelPaths(args.models, args.results, args.name),
        args.pretrained, args.classifier, args.fraction, args.networks,
        packed=args.packed,
    ).show()


if __name__ == "__main__":
    main()
