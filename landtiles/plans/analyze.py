"""Job: quality of the test predictions and a land-use map of the scored tiles."""

import argparse

from pyspark.sql import DataFrame, SparkSession

from landtiles.fixed import SOURCE_NETWORK
from landtiles.operators.geo import first_rows, join_report, locate, pixel_table, raster_lines, raster_runs, raster_size
from landtiles.operators.metrics import (
    class_report,
    confusion_blocks,
    confusion_cells,
    one_vs_rest,
    outside_predictions,
    overall_accuracy,
    stored_counts,
)
from landtiles.plans.common import model_card, model_source, pairs_of
from landtiles.session import cut, job_session
from landtiles.sinks.tables import ModelPaths
from landtiles.sources.tables import read_predictions, read_test_predictions, read_tile_index

# The column of test predictions that names the tile, by the source of the model.
PATH_COLUMN = {SOURCE_NETWORK: "filename"}


def quality(
    spark: SparkSession,
    paths: ModelPaths,
    source_names: dict[str, str] | None = None,
    field_names: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Writes what the model's card says and the reports on the test predictions, and returns them as stored."""
    card = model_card(spark, paths, field_names)
    column = PATH_COLUMN.get(model_source(card, source_names), "filepath")
    tested = read_test_predictions(spark, paths.test_predictions, column)
    counts = stored_counts(tested)
    described = spark.createDataFrame([tuple(card.values())], ", ".join(f"{c} string" for c in card))
    per_class = _report(paths, "per_class", one_vs_rest(counts))
    return {
        "card": _report(paths, "card", described.coalesce(1)),
        "accuracy": _report(paths, "accuracy", overall_accuracy(counts)),
        "per_class": per_class,
        "class_report": _report(paths, "class_report", class_report(per_class)),
        "confusion": _report(paths, "confusion", confusion_cells(counts)),
        "confusion_blocks": _report(paths, "confusion_blocks", confusion_blocks(counts)),
        "outside": _report(paths, "outside", outside_predictions(counts)),
    }


def land_map(
    spark: SparkSession, paths: ModelPaths, tile_index: str, on_unknown: str = "error", dense: bool = False
) -> dict[str, DataFrame]:
    """Writes the located predictions, how they matched, and their map, and returns them as stored.

    Each of the two inputs is read and parsed once. The map is stored as runs of painted pixels and its size; the
    whole picture only if it is asked for.
    """
    predictions = cut(read_predictions(spark, paths.predictions), "predictions")
    tiles = cut(read_tile_index(spark, tile_index), "tiles")
    located = _report(paths, "located", locate(predictions, tiles))
    pixels = _report(paths, "pixels", pixel_table(located, on_unknown))
    found = {
        "located": located,
        "located_head": _report(paths, "located_head", first_rows(located)),
        "join_report": _report(paths, "join_report", join_report(predictions, tiles)),
        "pixels": pixels,
        "map_runs": _report(paths, "map_runs", raster_runs(pixels)),
        "map_size": _report(paths, "map_size", raster_size(pixels)),
    }
    if dense:
        found["map_lines"] = _report(paths, "map_lines", raster_lines(found["map_runs"], found["map_size"]))
    return found


def analyze(
    spark: SparkSession,
    paths: ModelPaths,
    tile_index: str,
    on_unknown: str = "error",
    source_names: dict[str, str] | None = None,
    field_names: dict[str, str] | None = None,
    dense: bool = False,
) -> dict[str, DataFrame]:
    """All reports on one model."""
    return quality(spark, paths, source_names, field_names) | land_map(spark, paths, tile_index, on_unknown, dense)


def _report(paths: ModelPaths, name: str, frame: DataFrame) -> DataFrame:
    path = f"{paths.results}/{paths.name}_{name}"
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--models", required=True, help="folder with models and their cards")
    parser.add_argument("--results", required=True, help="folder with the predictions")
    parser.add_argument("--tile-index", required=True, help="CSV with the bounds of each tile")
    parser.add_argument("-o", "--name", required=True, help="name of the model")
    parser.add_argument("--on-unknown", choices=("error", "black"), default="error")
    parser.add_argument("--dense", action="store_true", help="store the whole map too, black where no tile lies")
    parser.add_argument("--source-name", action="append", default=[], metavar="OTHER=KNOWN",
                        help="other spelling of a model source on a card")
    parser.add_argument("--field-name", action="append", default=[], metavar="OTHER=KNOWN",
                        help="other name of a field on a card")
    args = parser.parse_args(argv)
    reports = analyze(
        job_session("analyze"), ModelPaths(args.models, args.results, args.name), args.tile_index, args.on_unknown,
        pairs_of(args.source_name), pairs_of(args.field_name), args.dense,
    )
    for name in ("card", "accuracy", "located_head"):
        reports[name].show(truncate=False)
    for row in reports["class_report"].orderBy("label").toLocalIterator():
        print(*row, sep="\t")


if __name__ == "__main__":
    main()
