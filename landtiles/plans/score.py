"""Job: apply a saved model to a large folder of unlabelled tiles."""

import argparse
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession

from landtiles.fixed import SOURCE_NETWORK, TILE_SIDE
from landtiles.operators.featurize import OnnxNetwork, featurize
from landtiles.operators.models import apply_classifier, apply_network, load_model
from landtiles.plans.checks import check_fraction
from landtiles.plans.common import (
    feature_extractor,
    flat_tiles,
    model_card,
    model_source,
    pairs_of,
    record,
    record_predicted,
    record_seen,
)
from landtiles.session import job_session, tile_job
from landtiles.sinks.tables import ModelPaths, write_predictions
from landtiles.sources.tables import read_label_index, read_predictions


@tile_job
def score(
    spark: SparkSession,
    tiles_root: str,
    paths: ModelPaths,
    fraction: float = 1.0,
    networks: str | None = None,
    side: int = TILE_SIDE,
    source_names: dict[str, str] | None = None,
    field_names: dict[str, str] | None = None,
    packed: bool = False,
) -> DataFrame:
    """Writes ``filepath, pred_label`` and returns them as read back.

    ``source_names`` maps other spellings of the model source on a card to ``classifier`` or ``dnn``, ``field_names``
    other names of fields to those of this suite.
    """
    check_fraction(fraction)
    seen, run_id = Observation("scoring"), uuid.uuid4().hex
    tiles = flat_tiles(spark, tiles_root, fraction, packed, seen)
    card = model_card(spark, paths, field_names)
    if model_source(card, source_names) == SOURCE_NETWORK:
        scores = featurize(tiles, OnnxNetwork(spark, paths.network), side)
        predictions = apply_network(scores, read_label_index(spark, paths.label_index))
    else:
        extractor = feature_extractor(spark, networks, card["pretrained_model_type"])
        predictions = apply_classifier(
            load_model(paths.classifier), featurize(tiles, extractor, side)
        )
    record(spark, paths, run_id, scored_model=paths.name, sample_frac=fraction)
    write_predictions(predictions, paths.predictions)
    record_seen(spark, paths, run_id, seen)
    written = read_predictions(spark, paths.predictions)
    record_predicted(written, paths, run_id)
    return written


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tiles-root", required=True, help="flat folder of PNG tiles")
    parser.add_argument("--models", required=True, help="folder with models and their cards")
    parser.add_argument("--results", required=True, help="folder for predictions and metrics")
    parser.add_argument("--networks", help="folder with <pretrained type>.onnx files")
    parser.add_argument("-o", "--name", required=True, help="name of the model")
    parser.add_argument("-f", "--fraction", type=float, default=1.0, help="share of tiles to use")
    parser.add_argument("--source-name", action="append", default=[], metavar="OTHER=KNOWN",
                        help="other spelling of a model source on a card")
    parser.add_argument("--field-name", action="append", default=[], metavar="OTHER=KNOWN",
                        help="other name of a field on a card")
    parser.add_argument("--packed", action="store_true", help="roots are tables of packed tiles")
    args = parser.parse_args(argv)
    check_fraction(args.fraction)
    score(
        job_session("score"), args.tiles_root, ModelPaths(args.models, args.results, args.name),
        args.fraction, args.networks,
        source_names=pairs_of(args.source_name), field_names=pairs_of(args.field_name),
        packed=args.packed,
    )


if __name__ == "__main__":
    main()
