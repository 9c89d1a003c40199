"""One query per operator or job, over whole given tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landtiles.fixed import CARD_FIELDS
from landtiles.functions.paths import base_name, class_name
from landtiles.functions.vectors import argmax, decimals, hash_fraction
from landtiles.operators import featurize as fz
from landtiles.operators import geo, head, labels, metrics, models, runlog
from landtiles.plans.analyze import analyze, land_map, quality
from landtiles.plans.log_report import log_report
from landtiles.plans.pack import pack
from landtiles.plans.retrain import retrain
from landtiles.plans.score import score
from landtiles.plans.train import train
from landtiles.session import cut, scratch_path
from landtiles.sinks import tables as sinks
from landtiles.sources import images, manifest, tables
from samples.network import network_file
from samples.tiles import SIDE, shown_tiles, tile_folder
from samples.views import view

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def rounded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.round(c, 9) for c in columns})


def joined_numbers(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("int").cast("string")), " ")


# ---- paths and labels


@query
def path_label_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    return view(spark, sf_dir, "paths").select(
        "page_id", class_name(path).alias("label"), base_name(path).alias("name")
    )


def tile_files(spark, sf_dir):
    return view(spark, sf_dir, "tile_files").withColumn("label", class_name(F.col("filename")))


@query
def label_index(spark, sf_dir):
    return labels.label_index(tile_files(spark, sf_dir))


@query
def map_file(spark, sf_dir):
    """The position in the shuffled file list stands for the order of its rows."""
    files = tile_files(spark, sf_dir).select("filename", "label")
    rows = labels.map_rows(files, labels.label_index(files), seed="7")
    return labels.positions(rows, ["shuffle_key", "filename"], "position").drop("shuffle_key")


@query
def class_and_size(spark, sf_dir):
    return labels.class_and_size(tile_files(spark, sf_dir))


@query
def hash_sample(spark, sf_dir):
    key = F.concat_ws("/", class_name(F.col("filename")), base_name(F.col("filename")))
    return images.sampled(view(spark, sf_dir, "tile_files"), key, 0.25).select("o_orderkey", "filename")


@query
def argmax_label(spark, sf_dir):
    scores = view(spark, sf_dir, "scores")
    widest = scores.agg(F.max(F.size("scores")).alias("n")).select(F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("position"))
    name = F.concat(F.lit("class_"), F.lpad(F.col("position").cast("string"), 2, "0"))
    index = labels.label_index(widest.select(name.alias("label")))
    return labels.predict_label(scores, "scores", index).select(
        "vec_id", argmax(F.col("scores")).cast("bigint").alias("idx"), "pred_label"
    )


# ---- metrics


def pred_counts(spark, sf_dir):
    return metrics.confusion_counts(view(spark, sf_dir, "pred"))


@query
def overall_accuracy(spark, sf_dir):
    return rounded(metrics.overall_accuracy(pred_counts(spark, sf_dir)), "accuracy")


@query
def one_vs_rest(spark, sf_dir):
    found = metrics.one_vs_rest(pred_counts(spark, sf_dir))
    return rounded(found, "precision", "recall", "accuracy")


@query
def class_report(spark, sf_dir):
    return metrics.class_report(metrics.one_vs_rest(pred_counts(spark, sf_dir)))


@query
def confusion_long(spark, sf_dir):
    return metrics.confusion_matrix(metrics.stored_counts(view(spark, sf_dir, "pred")))


@query
def confusion_wide(spark, sf_dir):
    wide = metrics.confusion_wide(metrics.stored_counts(view(spark, sf_dir, "pred")))
    return wide.select("label", *(F.col(c).alias(f"pred_{c}") for c in wide.columns[1:]))


@query
def confusion_cells(spark, sf_dir):
    return metrics.confusion_cells(metrics.stored_counts(view(spark, sf_dir, "pred_big")))


@query
def confusion_blocks(spark, sf_dir):
    """Blocks of three columns."""
    found = metrics.confusion_blocks(metrics.stored_counts(view(spark, sf_dir, "pred")), width=3)
    cells = F.transform("cells", lambda c: F.concat_ws(":", c["at"], c["n"]))
    return found.select("label", "block", F.array_join(cells, " ").alias("cells"))


@query
def metrics_at_scale(spark, sf_dir):
    counts = metrics.stored_counts(view(spark, sf_dir, "pred_big"))
    outside = metrics.outside_predictions(counts).scalar()
    found = metrics.one_vs_rest(counts).withColumn("n_outside", outside)
    return rounded(found, "precision", "recall", "accuracy")


@query
def confusion_at_scale(spark, sf_dir):
    return metrics.confusion_matrix(metrics.stored_counts(view(spark, sf_dir, "pred_big")))


# ---- tiles on the ground


def predictions(spark, sf_dir):
    return tables.named(view(spark, sf_dir, "scored"), "filepath")


def tile_bounds(spark, sf_dir):
    return tables.named(view(spark, sf_dir, "tile_index"), "filename")


def located(spark, sf_dir):
    return geo.locate(predictions(spark, sf_dir), tile_bounds(spark, sf_dir))


@query
def located_predictions(spark, sf_dir):
    return located(spark, sf_dir)


@query
def unmatched_tiles(spark, sf_dir):
    return geo.join_report(predictions(spark, sf_dir), tile_bounds(spark, sf_dir))


@query
def head_tiles(spark, sf_dir):
    return geo.first_rows(located(spark, sf_dir))


@query
def grid_index(spark, sf_dir):
    return geo.grid_index(located(spark, sf_dir)).select("name", "pred_label", "x_idx", "y_idx", "max_y_idx")


@query
def pixel_table(spark, sf_dir):
    return geo.pixel_table(located(spark, sf_dir))


def hex_lines(lines: DataFrame) -> DataFrame:
    def two(value):
        return F.lpad(F.hex(value), 2, "0")

    text = F.transform("pixels", lambda p: F.concat(two(p["r"]), two(p["g"]), two(p["b"])))
    return lines.select("row_idx", "block_idx", F.array_join(text, "").alias("line"))


@query
def raster_lines(spark, sf_dir):
    """Blocks of 64 pixels, so that every line spans several."""
    pixels = geo.pixel_table(located(spark, sf_dir))
    return hex_lines(geo.raster_lines(geo.raster_runs(pixels), geo.raster_size(pixels), block=64))


def run_text(runs: DataFrame) -> DataFrame:
    def one(run):
        colour = F.concat(*(F.lpad(F.hex(run[c]), 2, "0") for c in "rgb"))
        return F.concat_ws(":", run["col_idx"], run["n"], colour)

    return runs.select("z", "row_idx", F.array_join(F.transform("runs", one), " ").alias("runs"))


@query
def raster_runs(spark, sf_dir):
    """The sparse map, in blocks of 16 x 16 pixels."""
    return run_text(geo.raster_runs(geo.pixel_table(located(spark, sf_dir)), side=16))


@query
def raster_size(spark, sf_dir):
    return geo.raster_size(geo.pixel_table(located(spark, sf_dir)))


# ---- logs, cards, run metrics


def stored_log(spark, sf_dir):
    path = scratch_path(spark, "sample-log")
    view(spark, sf_dir, "loglines").select("value").write.text(path)
    return path


def logged_means(spark, sf_dir):
    lines = tables.read_lines(spark, stored_log(spark, sf_dir))
    return runlog.epoch_means(runlog.epoch_lines(lines))


@query
def epoch_means(spark, sf_dir):
    return rounded(logged_means(spark, sf_dir), "loss", "error_pct", "duration", "rate")


def series_text(rows: DataFrame) -> Column:
    return F.array_join(F.transform("series", lambda v: decimals(v, 4)), " ").alias("series")


@query
def epoch_series(spark, sf_dir):
    found = runlog.epoch_series(logged_means(spark, sf_dir))
    return found.select("metric", series_text(found))


@query
def log_accuracy(spark, sf_dir):
    return runlog.log_accuracy(tables.read_lines(spark, stored_log(spark, sf_dir)))


@query
def run_metrics(spark, sf_dir):
    """Accuracy of the big predictions and the series of the log, appended and read back."""
    path = scratch_path(spark, "run-metrics")
    counts = metrics.confusion_counts(view(spark, sf_dir, "pred_big"))
    accuracy = metrics.overall_accuracy(counts)
    runlog.append_metrics(
        runlog.value_metrics(accuracy, "run", "accuracy_on_test_set", "accuracy"), path
    )
    series = runlog.epoch_series(logged_means(spark, sf_dir))
    runlog.append_metrics(runlog.series_metrics(series, "run"), path)
    found = runlog.read_metrics(spark, path)
    return found.select(
        "run_id", "metric", F.round("value_double", 9).alias("value_double"), series_text(found)
    )


def card_lines(spark, sf_dir):
    fields = [F.concat(F.lit(f"{c},"), c) for c in CARD_FIELDS]
    cards = view(spark, sf_dir, "card_values")
    return cards.select(
        F.col("output_model_name").alias("model"), F.explode(F.array(*fields, F.lit(""))).alias("value")
    )


@query
def model_card_row(spark, sf_dir):
    fields = tables.card_fields(card_lines(spark, sf_dir), ["model"])
    return tables.card_rows(fields, ["model"], CARD_FIELDS)


@query
def card_roundtrip(spark, sf_dir):
    """Cards of many models as one table of lines, stored and read back."""
    lines = cut(card_lines(spark, sf_dir), "cards")
    return tables.card_rows(tables.card_fields(lines, ["model"]), ["model"], CARD_FIELDS)


# ---- files written and read back


@query
def predictions_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(view(spark, sf_dir, "scored"), path)
    return tables.read_predictions(spark, path)


@query
def test_predictions_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "test-predictions")
    name = F.concat_ws("/", F.lit("test"), "l_orderkey", "l_linenumber").alias("filepath")
    sinks.write_test_predictions(
        view(spark, sf_dir, "pred_big").select(name, "label", "pred_label"), path
    )
    return tables.read_test_predictions(spark, path)


@query
def tile_index_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "tile-index")
    sinks.write_tile_index(view(spark, sf_dir, "tile_index"), path)
    return tables.read_tile_index(spark, path)


@query
def label_index_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "label-index")
    sinks.write_label_index(labels.label_index(tile_files(spark, sf_dir)), path)
    return tables.read_label_index(spark, path)


@query
def map_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "map-file")
    files = tile_files(spark, sf_dir).select("filename", "label")
    sinks.write_map_file(labels.map_rows(files, labels.label_index(files)), path)
    return tables.read_map_file(spark, path)


# ---- image tiles


def tiles(spark, sf_dir):
    return images.read_labelled_tiles(spark, tile_folder(spark, sf_dir))


def tile_name() -> Column:
    return base_name(F.col("filepath")).alias("name")


@query
def image_stats(spark, sf_dir):
    """Size and channel sums from the block means: 64 blocks of one pixel per channel."""
    found = fz.featurize(
        tiles(spark, sf_dir).withColumn("height", F.col("image.height")).withColumn("width", F.col("image.width")),
        fz.BlockFeatures(blocks=SIDE, mean=0.0), SIDE, mean=0.0,
    )

    def channel(i):
        block = F.slice("features", i * SIDE * SIDE + 1, SIDE * SIDE)
        return F.aggregate(block, F.lit(0.0), lambda s, v: s + v.cast("double")).cast("bigint")

    return found.select(
        tile_name(), "label", "height", "width",
        channel(2).alias("red"), channel(1).alias("green"), channel(0).alias("blue"),
    )


def stored_manifest(spark, root, labelled, **options):
    path = scratch_path(spark, "manifest")
    manifest.write_manifest(manifest.names_in(spark, root, labelled, **options), path, range_names=500)
    return path


@query
def flat_images(spark, sf_dir):
    """Tiles by a manifest of their names, which come from a tile index."""
    root = tile_folder(spark, sf_dir, labelled=False)
    index = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.concat(F.lit("tiles/tile_"), "vec_id", F.lit(".png")).alias("filename")
    )
    path = scratch_path(spark, "manifest")
    manifest.write_manifest(manifest.names_of(index, "filename", labelled=False), path, range_names=500)
    found = manifest.read_manifest(spark, path, root, labelled=False)
    return found.toDF("name", "tile").select(
        "name", F.col("tile.height").alias("height"), F.col("tile.nChannels").alias("channels"),
        F.hex("tile.data").alias("bgr"),
    )


def packed_bgr(found):
    return found.select(tile_name(), *(["label"] if "label" in found.columns else []), F.hex("image.data").alias("bgr"))


@query
def packed_tiles(spark, sf_dir):
    """Tiles stored as a table by overlapping patterns of class folders, in several passes, and read from there."""
    path = scratch_path(spark, "packed")
    root = tile_folder(spark, sf_dir)
    for patterns in (["class_[0-4]", "class_[3-9]"], ["class_*"]):
        pack(spark, root, path, patterns, ranges_per_pass=1)
    return packed_bgr(images.read_packed_tiles(spark, path))


@query
def packed_flat_tiles(spark, sf_dir):
    """Tiles of a flat folder stored as a table, twice, and read from there."""
    path = scratch_path(spark, "packed")
    root = tile_folder(spark, sf_dir, labelled=False)
    for _ in range(2):
        pack(spark, root, path, None)
    return packed_bgr(images.read_packed_tiles(spark, path))


@query
def sampled_tiles(spark, sf_dir):
    found = images.read_labelled_tiles(spark, tile_folder(spark, sf_dir), fraction=0.3)
    return found.select(tile_name(), "label", F.col("image.width").alias("width"))


@query
def list_class_files(spark, sf_dir):
    """Files of any type, listed by tasks and counted from the manifest alone."""
    root = tile_folder(spark, sf_dir)
    path = stored_manifest(spark, root, True, pattern="*")
    files = manifest.read_manifest(spark, path, root, labelled=True, content=False)
    return files.groupBy("label").agg(F.count("*").alias("n_files"))


@query
def flat_images_by_folder(spark, sf_dir):
    """What the reader of folders gives, for those who have no manifest."""
    found = images.read_flat_tiles(spark, tile_folder(spark, sf_dir, labelled=False))
    return found.toDF("name", "tile").select(
        "name", F.col("tile.height").alias("height"), F.col("tile.nChannels").alias("channels"),
        F.hex("tile.data").alias("bgr"),
    )


@query
def featurize_blocks(spark, sf_dir):
    """Block means less the network mean, and value shares as counts of 64 pixels."""
    found = fz.featurize(tiles(spark, sf_dir), fz.BlockFeatures(), SIDE)
    means = F.slice("features", 1, 3 * SIDE * SIDE)
    shares = F.slice("features", 3 * SIDE * SIDE + 1, 24)
    return found.select(
        tile_name(), "label", joined_numbers(means).alias("means"),
        joined_numbers(F.transform(shares, lambda v: v * SIDE * SIDE)).alias("shares"),
    )


@query
def augmented_sizes(spark, sf_dir):
    """The numbers drawn for each tile, and the size of the tile made with them."""
    made = fz.augment(tiles(spark, sf_dir), F.lit(3), seed="s", side=16)
    drawn = made.select("*", *fz.draws(F.lit(3), "s"))
    return drawn.select(
        tile_name(), "label", F.col("image.height").alias("height"), F.length("image.data").alias("n_bytes"),
        *(F.round(c, 6).alias(c) for c in ("top", "left", "brightness", "contrast", "saturation")),
    )


@query
def augmented_features(spark, sf_dir):
    found = fz.featurize(tiles(spark, sf_dir), fz.BlockFeatures(), 16, epoch=F.lit(1))
    return found.select(tile_name(), "label", F.size("features").alias("n_features"))


@query
def onnx_featurize(spark, sf_dir):
    """The named inner layer of a network: mean of each channel, blue, green, red."""
    network = fz.OnnxNetwork(spark, network_file(spark, "features.onnx", SIDE), "z.x")
    found = fz.featurize(tiles(spark, sf_dir), network, SIDE)
    return found.select(
        tile_name(), *(F.col("features")[i].cast("double").alias(c) for i, c in enumerate("bgr"))
    )


def land_use_index(spark, sf_dir):
    return labels.label_index(view(spark, sf_dir, "scored").select(F.col("pred_label").alias("label")))


@query
def network_labels(spark, sf_dir):
    """Class scores of a network, fixed batch size, to the label of the largest."""
    network = fz.OnnxNetwork(spark, network_file(spark, "scores.onnx", SIDE, batch=48), "scores")
    scores = fz.featurize(tiles(spark, sf_dir), network, SIDE)
    return models.apply_network(scores, land_use_index(spark, sf_dir)).select(tile_name(), "label", "pred_label")


@query
def featurize_full_size(spark, sf_dir):
    """Every tile scaled to the size the networks take."""
    found = fz.featurize(tiles(spark, sf_dir))
    means = F.slice("features", 1, 192)
    total = F.aggregate(means, F.lit(0.0), lambda s, v: s + v.cast("double"))
    corner = F.round(F.col("features")[0].cast("double") * 64, 0).cast("bigint")
    return found.select(tile_name(), "label", F.round(total, 0).cast("bigint").alias("total"), corner.alias("corner"))


# ---- learning


@query
def linear_head(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").alias("features")
    )
    best = head.best_of_head(rows, cut(models.mean_head(rows), "head"))
    return best.select("vec_id", "pred_label", F.round("score", 6).alias("score"))


@query
def linear_head_blocks(spark, sf_dir):
    """All scores, from a head cut into tiles of 3 classes by 16 positions."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").alias("features")
    )
    scored = head.linear_head(rows, cut(models.mean_head(rows), "head"), classes=3, positions=16)
    found = scored.select("vec_id", F.posexplode("scores").alias("place", "score"))
    return found.select("vec_id", F.col("place").cast("bigint").alias("place"), F.round("score", 6).alias("score"))


def planted(spark, sf_dir):
    """Feature rows with a label that every method can learn: four of the numbers tell the class plainly.

    The class is the largest of the first four numbers of a row, as before its mark was added.
    """
    place = argmax(F.slice("embedding", 1, 4))
    marks = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.when(k == place, 10.0).otherwise(0.0).cast("float"))
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.concat(F.lit("tile_"), "vec_id").alias("filepath"),
        F.concat(F.lit("class_"), place).alias("label"),
        F.concat("embedding", marks).alias("features"),
    )


def learnt(rows: DataFrame) -> DataFrame:
    """The part of the rows that a model is fitted on; it is applied to all."""
    return rows.where(hash_fraction(F.col("filepath")) < 0.7)


def trained(spark, sf_dir, estimator):
    rows = planted(spark, sf_dir)
    return models.apply_classifier(models.train_classifier(learnt(rows), estimator), rows)


@query
def train_lr(spark, sf_dir):
    return trained(spark, sf_dir, models.logistic_regression())


@query
def train_rf(spark, sf_dir):
    return trained(spark, sf_dir, models.random_forest())


@query
def train_last_layer(spark, sf_dir):
    return trained(spark, sf_dir, models.last_layer())


@query
def train_mlp(spark, sf_dir):
    rows = planted(spark, sf_dir)
    return models.apply_classifier(models.train_dense_layers(learnt(rows)), rows)


@query
def score_saved_model(spark, sf_dir):
    rows = planted(spark, sf_dir)
    path = scratch_path(spark, "model")
    models.save_model(models.train_classifier(learnt(rows), models.random_forest()), path)
    return models.apply_classifier(models.load_model(path), rows)


# ---- jobs


def model_paths(spark, name):
    root = scratch_path(spark, "job")
    return sinks.ModelPaths(f"{root}/models", f"{root}/results", name)


@query
def job_train(spark, sf_dir):
    training, testing, _ = shown_tiles(spark, sf_dir)
    return train(spark, training, testing, model_paths(spark, "forest"), "resnet18", "randomforest")


@query
def job_retrain(spark, sf_dir):
    training, testing, _ = shown_tiles(spark, sf_dir)
    return retrain(spark, training, testing, model_paths(spark, "layer"), "alexnet", "last_only")


@query
def job_retrain_dense(spark, sf_dir):
    training, testing, _ = shown_tiles(spark, sf_dir)
    return retrain(spark, training, testing, model_paths(spark, "dense"), "alexnet", "fully_connected")


@query
def job_retrain_steps(spark, sf_dir):
    training, testing, _ = shown_tiles(spark, sf_dir)
    return retrain(spark, training, testing, model_paths(spark, "steps"), "alexnet", "last_only", solver="steps")


@query
def job_score(spark, sf_dir):
    training, testing, flat = shown_tiles(spark, sf_dir)
    paths = model_paths(spark, "logistic")
    train(spark, training, testing, paths, "alexnet", "logisticregression")
    return score(spark, flat, paths)


@query
def job_score_network(spark, sf_dir):
    """Same labels as ``network_labels``, by way of a card, a network file and a label index."""
    paths = model_paths(spark, "network")
    network_file(spark, "retrained.onnx", SIDE, folder=f"{paths.models}/network")
    sinks.write_label_index(land_use_index(spark, sf_dir), paths.label_index)
    sinks.write_card(spark, paths.card, {
        "output_model_name": "network", "model_source": "dnn", "pretrained_model_type": "resnet18",
        "retraining_type": "all", "classifier_type": "none",
    })
    return score(spark, tile_folder(spark, sf_dir, labelled=False), paths, side=SIDE)


def network_card(spark, paths):
    """A card as another program writes it: other names of a field and of the source."""
    lines = [("output_model_name,given",), ("model_source,net",), ("pretrained_model_type,alexnet",), ("retraining_type,last_only",),
             ("other_type,none",)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(paths.card)
    return {"source_names": {"net": "dnn"}, "field_names": {"other_type": "classifier_type"}}


def tested(spark, sf_dir, paths):
    """Test predictions as the network path writes them, whose first column is ``filename``."""
    name = F.concat_ws("/", F.lit("test"), "l_orderkey", "l_linenumber").alias("filename")
    rows = view(spark, sf_dir, "pred_big").select(name, "label", "pred_label")
    rows.write.csv(paths.test_predictions, header=True, escape='"')


def mapped(spark, sf_dir):
    paths = model_paths(spark, "given")
    sinks.write_predictions(view(spark, sf_dir, "scored"), paths.predictions)
    bounds = f"{paths.results}/tile_summaries.csv"
    sinks.write_tile_index(view(spark, sf_dir, "tile_index"), bounds)
    return paths, bounds


@query
def job_analyze(spark, sf_dir):
    """The whole job; its sparse map of the scored tiles."""
    paths, bounds = mapped(spark, sf_dir)
    tested(spark, sf_dir, paths)
    return run_text(analyze(spark, paths, bounds, **network_card(spark, paths))["map_runs"])


@query
def job_analyze_located(spark, sf_dir):
    paths, bounds = mapped(spark, sf_dir)
    return land_map(spark, paths, bounds)["located"]


@query
def job_analyze_classes(spark, sf_dir):
    paths = model_paths(spark, "given")
    tested(spark, sf_dir, paths)
    found = quality(spark, paths, **network_card(spark, paths))
    card = found["card"].first().asDict()
    return rounded(found["per_class"], "precision", "recall", "accuracy").withColumns({c: F.lit(v) for c, v in card.items()})


@query
def job_log_report(spark, sf_dir):
    found = log_report(spark, stored_log(spark, sf_dir), scratch_path(spark, "run-metrics"), "run")
    return found.select(
        "run_id", "metric", F.round("value_double", 9).alias("value_double"), series_text(found)
    )
