import os
import shutil

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landtiles.functions.paths import base_name
from landtiles.operators import head, models, runlog
from landtiles.operators.featurize import BlockFeatures, featurize
from landtiles.operators.labels import label_index
from landtiles.plans import checks
from landtiles.plans import train as train_job
from landtiles.plans.analyze import analyze
from landtiles.plans.pack import pack
from landtiles.plans.retrain import retrain
from landtiles.plans.common import model_card
from landtiles.plans.score import score
from landtiles.plans.train import train
from landtiles.session import cut
from landtiles.sinks import tables as sinks
from landtiles.sources import images
from landtiles.sources.images import read_labelled_tiles
from samples.network import network_file
from samples.tiles import write_png

SIDE = 8
CLASSES = ["Barren", "Developed", "Forest"]


@pytest.fixture(scope="module")
def planted(spark):
    """Feature rows whose class is the largest of the first four numbers."""
    rng = np.random.default_rng(0)
    values = rng.normal(size=(600, 8)).astype(float)
    rows = [(f"t{i}", v.tolist(), f"k{int(np.argmax(v[:4]))}") for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "filepath string, features array<double>, label string")
    return frame.withColumn("features", F.col("features").cast("array<float>")).cache()


def accuracy(rows):
    return rows.agg(F.avg((F.col("label") == F.col("pred_label")).cast("int"))).first()[0]


def split(rows):
    held = F.substring("filepath", 2, 9).cast("int") % 5 == 4
    return rows.where(~held), rows.where(held)


@pytest.mark.parametrize("estimator, least", [
    (models.logistic_regression, 0.75), (models.random_forest, 0.6), (models.last_layer, 0.85),
])
def test_classifiers_learn_a_planted_rule(planted, estimator, least):
    training, testing = split(planted)
    found = models.apply_classifier(models.train_classifier(training, estimator()), testing)
    assert found.columns == ["filepath", "label", "pred_label"]
    assert accuracy(found) >= least


def test_dense_layers_learn_a_planted_rule(planted):
    training, testing = split(planted)
    assert accuracy(models.apply_classifier(models.train_dense_layers(training, 16), testing)) >= 0.75


def test_settings():
    forest, logistic = models.random_forest(), models.logistic_regression()
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (20, 5)
    assert (logistic.getRegParam(), logistic.getMaxIter()) == (0.01, 10)


def test_last_layer_is_at_the_minimum(planted):
    """The gradient of the penalised loss, worked out with numpy, vanishes."""
    estimator = models.last_layer().setStandardization(False).setTol(1e-10).setMaxIter(500)
    fitted = models.train_classifier(planted, estimator).stages[0]
    rows = planted.orderBy("filepath").collect()
    x = np.array([r.features for r in rows])
    y = np.eye(4)[[int(r.label[1:]) for r in rows]]
    w = fitted.coefficientMatrix.toArray()
    z = x @ w.T + fitted.interceptVector.toArray()
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    gradient = (p - y).T @ x / len(x) + 0.0005 * w
    assert np.abs(gradient).max() < 1e-4


def test_saved_model_predicts_alike(spark, planted, tmp_path):
    model = models.train_classifier(planted, models.random_forest())
    path = f"{tmp_path}/model"
    models.save_model(model, path)
    models.save_model(model, path)  # replaces
    unlabelled = planted.drop("label")
    before = dict(models.apply_classifier(model, unlabelled).collect())
    assert dict(models.apply_classifier(models.load_model(path), unlabelled).collect()) == before


def test_linear_head_by_brute_force(spark, planted):
    means = cut(models.mean_head(planted), "head").withColumn("b", F.length("label") * 0.25)
    rows = means.orderBy("label").collect()
    weights, bias = np.array([r.w for r in rows]), np.array([r.b for r in rows])
    names = [r.label for r in rows]
    for sizes in ({}, {"classes": 2, "positions": 3}, {"classes": 1, "positions": 1}):
        for r in head.linear_head(planted, means, **sizes).collect():
            assert np.allclose(r.scores, weights @ np.array(r.features) + bias, atol=1e-9)
        for r in head.best_of_head(planted, means, **sizes).collect():
            scores = weights @ np.array(r.features) + bias
            assert r.pred_label == names[scores.argmax()] and abs(r.score - scores.max()) < 1e-9
    with pytest.raises(ValueError, match="without classes"):
        head.linear_head(planted, means.limit(0))
    with pytest.raises(ValueError, match="one row a class"):
        head.linear_head(planted, means.union(means))


def test_head_of_very_many_classes(spark):
    """Class k points to angle k, so the best class of a point is the one with the nearest angle."""
    n = 100_000
    angle = F.col("id") * (2 * np.pi / n)
    classes = spark.range(n).select(
        F.lpad(F.col("id").cast("string"), 6, "0").alias("label"), F.array(F.cos(angle), F.sin(angle)).alias("w"), F.lit(0.0).alias("b")
    )
    wanted = [7, 33_333, 50_000, 99_999]
    points = [(k, [float(3 * np.cos(2 * np.pi * k / n)), float(3 * np.sin(2 * np.pi * k / n))]) for k in wanted]
    found = head.best_of_head(spark.createDataFrame(points, "k bigint, features array<double>"), classes, positions=1).collect()
    assert {r.k: (int(r.pred_label), round(r.score, 9)) for r in found} == {k: (k, 3.0) for k in wanted}
    equal = spark.createDataFrame([("b", [1.0], 0.0), ("a", [1.0], 0.0), ("c", [0.5], 0.0)], "label string, w array<double>, b double")
    best = head.best_of_head(spark.createDataFrame([([2.0],)], "features array<double>"), equal, classes=1).first()
    assert (best.pred_label, best.score) == ("a", 2.0)


def test_head_tables_are_joined_without_a_scalar_subquery(spark, planted):
    means = cut(models.mean_head(planted), "head")
    plan = head.best_of_head(planted, means)._jdf.queryExecution().analyzed().toString()
    assert "scalar-subquery" not in plan


def test_linear_head_takes_no_uneven_rows(spark):
    given = spark.createDataFrame([("a", [1.0, 0.0], 0.0), ("b", [0.0, 1.0], 0.5)], "label string, w array<double>, b double")
    for rows in ([([1.0, 2.0, 3.0],), ([4.0],)], [([1.0, 2.0],), (None,)]):
        frame = spark.createDataFrame(rows, "features array<float>")
        with pytest.raises(Exception, match="do not fit"):
            head.linear_head(frame, given).collect()


@pytest.fixture(scope="module")
def tiles(spark, tmp_path_factory):
    """Two labelled folders and a flat one; a class is the strongest channel."""
    root = tmp_path_factory.mktemp("land")
    rng = np.random.default_rng(2)
    bounds = []
    for folder, n in (("train", 150), ("test", 60), ("county", 80)):
        rows = []
        for i in range(n):
            k = i % 3
            pixels = rng.integers(0, 120, (3, SIDE * SIDE))
            pixels[k] += 100
            name = f"tile_{i}.png" if folder == "county" else f"{CLASSES[k]}/tile_{i}.png"
            rows.append((name, *pixels.tolist()))
            if folder == "county":
                bounds.append((f"x/{name}", float(i // 10), float(i % 10), i // 10 + 1.0, i % 10 + 1.0))
        frame = spark.createDataFrame(rows, "name string, r array<int>, g array<int>, b array<int>")
        assert write_png(frame, f"{root}/{folder}", SIDE) == n
    index = spark.createDataFrame(
        bounds, "filename string, llcrnrlat double, llcrnrlon double, urcrnrlat double, urcrnrlon double"
    )
    sinks.write_tile_index(index, f"{root}/county/tile_summaries.csv")
    return str(root)


def expected(name):
    return CLASSES[int(name.removeprefix("tile_").removesuffix(".png")) % 3]


@pytest.mark.parametrize("kind", ["randomforest", "logisticregression"])
def test_train_score_and_analyze(spark, tiles, tmp_path, kind):
    paths = sinks.ModelPaths(f"{tmp_path}/models", f"{tmp_path}/results", "m")
    row = train(spark, f"{tiles}/train", f"{tiles}/test", paths, "resnet18", kind, side=SIDE).first()
    assert row.n_total == 60 and row.accuracy >= 0.9
    assert model_card(spark, paths) == {
        "output_model_name": "m", "model_source": "classifier", "pretrained_model_type": "resnet18",
        "retraining_type": "last_only", "classifier_type": kind,
    }
    recorded = {r.metric: r.value_double for r in runlog.read_metrics(spark, paths.metrics).collect()}
    assert recorded["accuracy_on_test_set"] == row.accuracy and recorded["sample_frac"] == 1.0

    found = dict(score(spark, f"{tiles}/county", paths, side=SIDE).collect())
    assert len(found) == 80
    assert np.mean([expected(n) == p for n, p in found.items()]) >= 0.9

    reports = analyze(spark, paths, f"{tiles}/county/tile_summaries.csv", dense=True)
    assert reports["accuracy"].first().accuracy == row.accuracy
    assert reports["join_report"].first().n_located == 80
    assert [r.name for r in reports["located_head"].collect()] == sorted(found)[:5]
    assert {r.name: r.pred_label for r in reports["located"].collect()} == found
    assert reports["card"].first().asDict() == model_card(spark, paths)
    assert tuple(reports["map_size"].first()) == (8, 10)
    assert sum(run.n for line in reports["map_runs"].collect() for run in line.runs) == 80
    lines = reports["map_lines"].collect()
    assert len(lines) == 8 and all(len(r.pixels) == 10 for r in lines)
    assert {r.label for r in reports["per_class"].collect()} == set(CLASSES)


def test_sample_fraction_is_honoured(spark, tiles, tmp_path):
    paths = sinks.ModelPaths(f"{tmp_path}/models", f"{tmp_path}/results", "m")
    row = train(
        spark, f"{tiles}/train", f"{tiles}/test", paths, "alexnet", "logisticregression", 0.5, side=SIDE
    ).first()
    assert 10 < row.n_total < 50


@pytest.mark.parametrize("depth", ["last_only", "fully_connected"])
def test_retrain(spark, tiles, tmp_path, depth):
    paths = sinks.ModelPaths(f"{tmp_path}/models", f"{tmp_path}/results", "r")
    row = retrain(
        spark, f"{tiles}/train", f"{tiles}/test", paths, "alexnet", depth, epochs=2, side=SIDE
    ).first()
    assert row.n_total == 60 and row.accuracy >= 0.8
    index = dict(spark.read.csv(paths.label_index, sep="\t", schema="l string, i int").collect())
    assert index == {c: i for i, c in enumerate(CLASSES)}
    assert spark.read.text(f"{paths.models}/r/map_train.tsv").count() == 150
    found = dict(score(spark, f"{tiles}/county", paths, side=SIDE).collect())
    assert np.mean([expected(n) == p for n, p in found.items()]) >= 0.8


def test_metrics_come_from_the_one_scan_of_the_job(spark, tiles, tmp_path, monkeypatch):
    broken = b"\x89PNG\r\n\x1a\nbroken"
    shutil.copytree(tiles, f"{tmp_path}/land")
    tiles = f"{tmp_path}/land"
    for name in ("train/Forest/x.png", "train/Barren/y.png", "test/Forest/z.png", "county/x.png"):
        with open(f"{tiles}/{name}", "wb") as file:
            file.write(broken)
    scans, scan = [], images._scan
    monkeypatch.setattr(images, "_scan", lambda spark, root, *a, **k: scans.append(root) or scan(spark, root, *a, **k))
    paths = sinks.ModelPaths(f"{tmp_path}/models", f"{tmp_path}/results", "m")
    train(spark, f"{tiles}/train", f"{tiles}/test", paths, "alexnet", "logisticregression", side=SIDE)
    found = {r.metric: r.value_double for r in spark.read.parquet(paths.metrics).where("value_string is null").collect()}
    counts = {name: found[name] for name in ("tiles_read", "tiles_unreadable", "test_tiles_read", "test_tiles_unreadable")}
    assert list(counts.values()) == [150, 2, 60, 1]
    written = score(spark, f"{tiles}/county", paths, side=SIDE)
    assert scans == [f"{tiles}/train", f"{tiles}/test", f"{tiles}/county"]
    rows = spark.read.parquet(paths.metrics).collect()
    run = next(r.run_id for r in rows if r.metric == "scored_model")
    own = [r for r in rows if r.run_id == run]
    assert {r.metric: r.value_double for r in own if r.metric.startswith("tiles")} == {"tiles_read": 80, "tiles_unreadable": 1}
    predicted = {r.value_string: r.value_double for r in own if r.metric == "n_predicted"}
    assert predicted == {r.pred_label: r["count"] for r in written.groupBy("pred_label").count().collect()}
    os.mkdir(f"{tmp_path}/none")
    with open(f"{tmp_path}/none/x.png", "wb") as file:
        file.write(broken)
    assert score(spark, f"{tmp_path}/none", paths, side=SIDE).collect() == []


def test_packed_tiles_give_the_same_results(spark, tiles, tmp_path):
    tables = {name: f"{tmp_path}/{name}" for name in ("train", "test", "county")}
    pack(spark, f"{tiles}/train", tables["train"], CLASSES)
    pack(spark, f"{tiles}/test", tables["test"], ["[BD]*", "Forest"])
    pack(spark, f"{tiles}/county", tables["county"], None)
    found = []
    for root, packed in ((None, False), (tables, True)):
        roots = root or {name: f"{tiles}/{name}" for name in tables}
        paths = sinks.ModelPaths(f"{tmp_path}/{packed}", f"{tmp_path}/{packed}", "m")
        row = train(spark, roots["train"], roots["test"], paths, "alexnet", "logisticregression",
                    0.7, side=SIDE, packed=packed).first()
        scored = dict(score(spark, roots["county"], paths, 0.7, side=SIDE, packed=packed).collect())
        found.append((row.n_total, sorted(scored)))
        assert row.accuracy > 0.9
    assert found[0] == found[1]


def network_model(spark, tmp_path, source):
    paths = sinks.ModelPaths(f"{tmp_path}/models", f"{tmp_path}/results", "n")
    network_file(spark, "retrained.onnx", SIDE, folder=f"{paths.models}/n")
    labels = spark.createDataFrame([(f"k{i}",) for i in range(6)], "label string")
    sinks.write_label_index(label_index(labels), paths.label_index)
    sinks.write_card(spark, paths.card, {
        "output_model_name": "n", "model_source": source, "pretrained_model_type": "resnet18",
        "retraining_type": "all", "classifier_type": "none",
    })
    return paths


def test_network_model_and_other_source_names(spark, tiles, tmp_path):
    paths = network_model(spark, tmp_path / "a", "dnn")
    found = dict(score(spark, f"{tiles}/county", paths, side=SIDE).collect())
    assert len(found) == 80 and set(found.values()) <= {f"k{i}" for i in range(6)}
    renamed = network_model(spark, tmp_path / "b", "gpu")
    with pytest.raises(ValueError, match="unknown model source gpu"):
        score(spark, f"{tiles}/county", renamed, side=SIDE)
    again = dict(score(spark, f"{tiles}/county", renamed, side=SIDE, source_names={"gpu": "dnn"}).collect())
    assert again == found


def test_missing_inputs_fail_before_any_work(spark, tiles, tmp_path):
    paths = sinks.ModelPaths(f"{tmp_path}/models", f"{tmp_path}/results", "m")
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        train(spark, f"{tiles}/none", f"{tiles}/test", paths, "resnet18", "randomforest")
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        score(spark, f"{tiles}/county", paths)
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        analyze(spark, paths, f"{tiles}/county/tile_summaries.csv")
    assert not (tmp_path / "models").exists() and not (tmp_path / "results").exists()


def test_no_tiles_in_class_folders(spark, tiles, tmp_path):
    paths = sinks.ModelPaths(f"{tmp_path}/models", f"{tmp_path}/results", "m")
    with pytest.raises(ValueError, match="no readable tiles"):
        train(spark, f"{tiles}/county", f"{tiles}/test", paths, "resnet18", "randomforest", side=SIDE)


@pytest.mark.parametrize("call", [
    lambda: checks.check_pretrained("vgg"),
    lambda: checks.check_classifier("svm"),
    lambda: checks.check_fraction(0.0),
    lambda: checks.check_fraction(1.01),
    lambda: checks.check_retraining("alexnet", "some", 1),
    lambda: checks.check_retraining("alexnet", "last_only", 0),
    lambda: checks.check_retraining("resnet18", "fully_connected", 1),
    lambda: checks.check_retraining("alexnet", "all", 1),
])
def test_bad_arguments(call):
    with pytest.raises(ValueError):
        call()


def test_command_line_checks():
    with pytest.raises(SystemExit):
        train_job.main(["-p", "vgg"])
    given = "--train-root a --test-root b --models c --results d -p alexnet -m randomforest -o x -f 2".split()
    with pytest.raises(ValueError, match="fraction"):
        train_job.main(given)


def test_scoring_sends_no_image_to_the_driver_and_has_no_shuffle(spark, tiles):
    rows = featurize(read_labelled_tiles(spark, f"{tiles}/train"), BlockFeatures(), SIDE)
    plan = rows.select(base_name(F.col("filepath")), "features")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
