import numpy as np
import pytest
from pyspark.sql import functions as F

from landtiles.operators import models, steps
from landtiles.operators.labels import label_index
from landtiles.plans import retrain as job
from landtiles.session import cut
from landtiles.sinks.tables import ModelPaths
from landtiles.sources.tables import read_test_predictions
from samples.tiles import write_png

FAST = ((0.002, None),)


@pytest.fixture(scope="module")
def planted(spark):
    """Feature rows whose class is the largest of the first three numbers, in two epochs, one tile's rows repeated."""
    rng = np.random.default_rng(0)
    values = rng.normal(size=(300, 5)) * [1, 1, 1, 50, 0] + [0, 0, 0, 9, 7]
    rows = [(f"t{i}", v.tolist(), f"k{int(np.argmax(v[:3]))}", e) for i, v in enumerate(values) for e in (1, 2, 3)]
    rows += [rows[0]] * 90
    return cut(spark.createDataFrame(rows, "filepath string, features array<float>, label string, epoch int").repartition(6), "planted")


def test_gradient_by_differences():
    rng = np.random.default_rng(1)
    layers = [4, 3, 5]
    weights = steps.first_weights(layers, 1) + rng.normal(size=35) * 0.1
    x, labels = rng.normal(size=(6, 4)), rng.integers(0, 5, 6)
    found, _, _ = steps.gradient(layers, weights, x, labels)
    for i in range(35):
        move = np.zeros(35)
        move[i] = 1e-6
        up, down = (steps.gradient(layers, weights + s * move, x, labels)[1] for s in (1, -1))
        assert abs(found[i] - (up - down) / 2e-6) < 1e-6


def test_blocks_hold_every_row_once(planted, tmp_path):
    plan = steps.Plan(3, step_rows=64, block_rows=20)
    steps.pack_steps(planted, label_index(planted), plan, f"{tmp_path}/blocks")
    blocks = planted.sparkSession.read.parquet(f"{tmp_path}/blocks").collect()
    found = []
    for b in blocks:
        values, labels = np.frombuffer(b.features, "<f4").reshape(b.rows, 5), np.frombuffer(b.labels, "<i4")
        assert 0 < b.rows <= 20
        found += [(b.epoch, int(k), *v.tolist()) for k, v in zip(labels, values)]
    expected = [(r.epoch, int(r.label[1:]), *r.features) for r in planted.collect()]
    assert sorted(found) == sorted(expected)
    assert len({(b.epoch, b.step) for b in blocks}) > 10


def test_sum_does_not_depend_on_the_layout(planted, tmp_path):
    plan = steps.Plan(1, step_rows=10_000, block_rows=16)
    steps.pack_steps(planted, label_index(planted), plan, f"{tmp_path}/blocks")
    blocks = planted.sparkSession.read.parquet(f"{tmp_path}/blocks")
    state = steps.first_state(planted, 3, steps.Plan(1, hidden=(2000,)))  # more weights than a piece has
    one, two = (steps.summed(blocks.repartition(n), state) for n in (1, 7))
    assert (one[0] == two[0]).all() and one[1:] == two[1:]
    rows = planted.collect()
    x = (np.array([r.features for r in rows]) - state.mean) / state.scale
    total, loss, errors = steps.gradient(state.layers, state.weights, x, np.array([int(r.label[1:]) for r in rows]))
    assert np.allclose(one[0], total, atol=1e-5) and one[1] == len(rows) and one[3] == errors
    assert abs(one[2] - loss) < 1e-5


@pytest.mark.parametrize("hidden", [(), (6,)])
def test_a_killed_run_goes_on_with_equal_weights(planted, tmp_path, monkeypatch, hidden):
    plan = steps.Plan(3, hidden, step_rows=100, block_rows=40, rates=FAST)
    index = cut(label_index(planted), "index")
    whole = steps.train_steps(planted, index, plan, f"{tmp_path}/whole")
    real, written = steps.write_state, []

    def killed(spark, state, path, epoch):
        if epoch == 2 and 2 not in written:
            written.append(epoch)
            raise KeyboardInterrupt
        written.append(epoch)
        real(spark, state, path, epoch)

    monkeypatch.setattr(steps, "write_state", killed)
    with pytest.raises(KeyboardInterrupt):
        steps.train_steps(planted, index, plan, f"{tmp_path}/killed")
    steps.train_steps(planted.repartition(3), index, plan, f"{tmp_path}/killed")
    assert written == [0, 1, 2, 2, 3]
    spark = planted.sparkSession
    (_, one), (_, two) = (steps.last_state(spark, f"{tmp_path}/{name}") for name in ("whole", "killed"))
    assert (one.weights == two.weights).all() and (one.speed == two.speed).all() and one.loss == two.loss
    # the stored kind of model says what the weights say
    rows = planted.where("epoch = 1")
    found = models.apply_classifier(whole, rows.select("filepath", "label", "features")).collect()
    given = rows.collect()
    x = (np.array([r.features for r in given]) - one.mean) / one.scale
    values, layers = x, steps.matrices(one.layers, one.weights)
    for matrix, bias in layers[:-1]:
        values = 1 / (1 + np.exp(-(values @ matrix.T + bias)))
    picked = (values @ layers[-1][0].T + layers[-1][1]).argmax(axis=1)
    assert sorted((r.filepath, r.pred_label) for r in found) == sorted((r.filepath, f"k{k}") for r, k in zip(given, picked))
    series = dict(steps.epoch_losses(spark, f"{tmp_path}/whole").collect())
    assert len(series["training_loss"]) == 3 and series["training_loss"][2] < series["training_loss"][0]
    assert np.mean([r.label == r.pred_label for r in found]) > 0.6


def test_runs_are_gone_on_with_until_they_end(spark, tmp_path):
    root = str(tmp_path)
    first = steps.open_run(spark, root, "a")
    assert steps.open_run(spark, root, "a") == first != steps.open_run(spark, root, "b")
    steps.enter_run(spark, root, first, "a", True)
    assert steps.open_run(spark, root, "a") != first


def test_job_resumes_without_reading_tiles_again(spark, tmp_path, monkeypatch):
    for part, count in (("train", 24), ("test", 10)):
        rows = [(f"{('Barren', 'Forest')[i % 2]}/{i}.png", *[[60 + 100 * (i % 2) + i] * 64] * 3) for i in range(count)]
        frame = spark.createDataFrame(rows, "name string, r array<int>, g array<int>, b array<int>")
        write_png(frame, f"{tmp_path}/{part}", 8)
    paths = ModelPaths(f"{tmp_path}/models", f"{tmp_path}/results", "s")
    given = (spark, f"{tmp_path}/train", f"{tmp_path}/test", paths, "alexnet", "last_only", 3)
    real = job.train_steps

    def killed(features, index, plan, path):
        real(features, index, steps.Plan(1, step_rows=plan.step_rows), path)
        raise KeyboardInterrupt

    monkeypatch.setattr(job, "train_steps", killed)
    with pytest.raises(KeyboardInterrupt):
        job.retrain(*given, side=8, solver="steps", step_rows=8)
    monkeypatch.setattr(job, "train_steps", real)
    row = job.retrain(*given, side=8, solver="steps", step_rows=8).first()
    assert row.n_total == 10 == read_test_predictions(spark, paths.test_predictions).count()
    metrics = spark.read.parquet(paths.metrics).where("metric = 'training_loss'").collect()
    assert [len(r.series) for r in metrics] == [3]
    runs = spark.read.parquet(f"{paths.models}/s/steps/runs")
    assert runs.select("run").distinct().count() == 1 and runs.agg(F.max("ended")).first()[0]
    with pytest.raises(ValueError, match="solver"):
        job.retrain(*given, side=8, solver="other")
