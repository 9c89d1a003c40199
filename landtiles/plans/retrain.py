"""Job: retrain the last layer, or the fully connected part, on augmented tiles."""

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landtiles.fixed import (
    DEFAULT_EPOCHS,
    FEATURE_LAYER,
    RETRAINING_TYPES,
    SOURCE_CLASSIFIER,
    TILE_SIDE,
)
from landtiles.operators.featurize import featurize
from landtiles.operators.labels import label_index, map_rows
from landtiles.operators.models import (
    apply_classifier,
    last_layer,
    save_model,
    train_classifier,
    train_dense_layers,
)
from landtiles.operators.runlog import append_metrics, series_metrics
from landtiles.operators.steps import (
    Plan,
    enter_run,
    epoch_losses,
    last_state,
    open_run,
    train_steps,
)
from landtiles.plans.checks import SOLVERS, check_fraction, check_retraining, check_solver
from landtiles.plans.common import (
    evaluate,
    feature_extractor,
    labelled_tiles,
    record,
    stored,
)
from landtiles.session import cut, job_session, tile_job
from landtiles.sinks.tables import ModelPaths, evened, write_card, write_label_index, write_map_file

HIDDEN = 64


@tile_job
def retrain(
    spark: SparkSession,
    train_root: str,
    validation_root: str,
    paths: ModelPaths,
    pretrained: str,
    depth: str,
    epochs: int = DEFAULT_EPOCHS,
    fraction: float = 1.0,
    networks: str | None = None,
    side: int = TILE_SIDE,
    packed: bool = False,
    solver: str = "full",
    step_rows: int = 256,
) -> DataFrame:
    """Returns one row ``n_total, n_correct, accuracy`` of the validation set.

    A tile is decoded and handed over once, then cropped and coloured anew for every epoch.
    The validation tiles stay as they are. Map files and label index list the tiles used.
    The ``full`` solver passes over the rows of all epochs until the fit stands; ``steps`` moves the weights after every
    ``step_rows`` rows, epoch by epoch, and a run that was killed goes on behind its last epoch.
    """
    check_retraining(pretrained, depth, epochs)
    check_fraction(fraction)
    check_solver(solver, step_rows)
    extractor = feature_extractor(spark, networks, pretrained)
    training = labelled_tiles(spark, train_root, fraction, packed)
    validation = labelled_tiles(spark, validation_root, fraction, packed)

    write_card(
        spark,
        paths.card,
        {
            "output_model_name": paths.name,
            "model_source": SOURCE_CLASSIFIER,
            "pretrained_model_type": pretrained,
            "retraining_type": depth,
            "classifier_type": "none",
        },
    )
    run_id = uuid.uuid4().hex
    record(
        spark, paths, run_id,
        pretrained_model_type=pretrained, retraining_type=depth,
        output_model_name=paths.name, num_epochs=epochs, sample_frac=fraction,
    )
    if solver == "steps":
        root = f"{paths.models}/{paths.name}/steps"
        plan = Plan(epochs, (HIDDEN,) if depth == "fully_connected" else (), step_rows)
        settings = repr((train_root, pretrained, networks, fraction, side, packed, plan))
        run = open_run(spark, root, settings)
        kept = f"{root}/{run}"
        if last_state(spark, kept) is None:
            rows = evened(featurize(training, extractor, side, epochs=epochs, epoch_column="epoch"))
            rows.write.mode("overwrite").parquet(f"{kept}/features")
        features = spark.read.parquet(f"{kept}/features")
        if features.isEmpty():
            raise ValueError("no readable tiles to train on")
    else:
        features = stored(featurize(training, extractor, side, epochs=epochs), "train-features")
    tested = cut(featurize(validation, extractor, side), "test-features")
    files = cut(used_files(features), "class-files")
    index = cut(label_index(files), "label-index")
    write_label_index(index, paths.label_index)
    write_map_file(map_rows(files, index), f"{paths.models}/{paths.name}/map_train.tsv")
    write_map_file(map_rows(used_files(tested), index), f"{paths.models}/{paths.name}/map_test.tsv")
    if solver == "steps":
        model = train_steps(features, index, plan, kept)
        append_metrics(series_metrics(epoch_losses(spark, kept), run_id), paths.metrics)
    elif depth == "last_only":
        model = train_classifier(features, last_layer())
    else:
        model = train_dense_layers(features, HIDDEN)
    save_model(model, paths.classifier)
    if solver == "steps":
        enter_run(spark, root, run, settings, True)
    return evaluate(apply_classifier(model, tested), paths, run_id)


def used_files(features: DataFrame) -> DataFrame:
    """``filename, label`` of the tiles that gave the features, once each."""
    return features.select(F.col("filepath").alias("filename"), "label").distinct()


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--train-root", required=True, help="folder with one folder per class")
    parser.add_argument("--validation-root", required=True, help="held-out folder, same shape")
    parser.add_argument("--models", required=True, help="folder for models and their cards")
    parser.add_argument("--results", required=True, help="folder for predictions and metrics")
    parser.add_argument("--networks", help="folder with <pretrained type>.onnx files")
    parser.add_argument("-p", "--pretrained", required=True, choices=tuple(FEATURE_LAYER))
    parser.add_argument("-r", "--retraining", required=True, choices=RETRAINING_TYPES)
    parser.add_argument("-o", "--name", required=True, help="name of the model")
    parser.add_argument("-f", "--fraction", type=float, default=1.0, help="share of tiles to use")
    parser.add_argument("-n", "--epochs", type=int, default=DEFAULT_EPOCHS)
    parser.add_argument("--solver", choices=SOLVERS, default="full")
    parser.add_argument("--step-rows", type=int, default=256, help="rows of a step, for the solver of steps")
    parser.add_argument("--packed", action="store_true", help="roots are tables of packed tiles")
    args = parser.parse_args(argv)
    check_fraction(args.fraction)
    check_solver(args.solver, args.step_rows)
    check_retraining(args.pretrained, args.retraining, args.epochs)
    retrain(
        job_session("retrain"), args.train_root, args.validation_root,
        ModelPaths(args.models, args.results, args.name),
        args.pretrained, args.retraining, args.epochs, args.fraction, args.networks,
        packed=args.packed, solver=args.solver, step_rows=args.step_rows,
    ).show()


if __name__ == "__main__":
    main()
