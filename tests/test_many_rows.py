"""Work that must not grow with the number of steps, and colours changed before tiles are scaled."""

import tracemalloc

import numpy as np
import pytest

from landtiles import session
from landtiles.functions import pixels
from landtiles.operators import steps
from landtiles.operators.labels import label_index
from landtiles.plans import retrain, score, train
from landtiles.session import cut


@pytest.mark.parametrize("hidden", [(), (5,)])
def test_steps_in_a_row_give_the_weights_of_single_steps(spark, tmp_path, monkeypatch, hidden):
    rng = np.random.default_rng(3)
    values = rng.normal(size=(200, 4))
    rows = [(f"t{i}", v.tolist(), f"k{int(np.argmax(v[:3]))}", e) for i, v in enumerate(values) for e in (1, 2)]
    features = cut(spark.createDataFrame(rows, "filepath string, features array<float>, label string, epoch int"), "planted")
    index = cut(label_index(features), "index")
    given = dict(epochs=2, hidden=hidden, step_rows=32, block_rows=12)
    steps.train_steps(features, index, steps.Plan(**given, run_rows=1), f"{tmp_path}/single")

    def no_job(*_):
        raise AssertionError("a job for one small step")

    monkeypatch.setattr(steps, "summed", no_job)
    for run_rows in (70, 1 << 16):  # several runs an epoch, and one
        steps.train_steps(features, index, steps.Plan(**given, run_rows=run_rows), f"{tmp_path}/{run_rows}")
        (_, one), (_, two) = (steps.last_state(spark, f"{tmp_path}/{name}") for name in ("single", run_rows))
        assert (one.weights == two.weights).all() and (one.speed == two.speed).all() and (one.square == two.square).all()
        assert (one.rows, one.errors) == (two.rows, two.errors) and abs(one.loss - two.loss) < 1e-6


@pytest.mark.parametrize("shape", [(7, 7), (3, 9), (30, 20)])
def test_colours_changed_before_scaling(shape):
    rng = np.random.default_rng(4)
    tiles, draws = rng.integers(0, 256, (5, *shape, 3), dtype=np.uint8), rng.random((5, 3))
    unrolled = pixels.unroll(tiles)
    expected = pixels.jitter(pixels.resize(unrolled, 16), draws)
    assert np.allclose(pixels.jitter_resized(unrolled, draws, 16), expected, atol=1e-3)


def test_small_tiles_are_stretched_without_copies_of_the_large_ones():
    tiles = pixels.unroll(np.random.default_rng(3).integers(0, 256, (4, 7, 7, 3), dtype=np.uint8))
    made = pixels.resize(tiles, 224)  # tables of lines are kept from here on
    tracemalloc.start()
    made = pixels.resize(tiles, 224)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1.5 * made.nbytes
    assert np.array_equal(pixels.resize(np.full((1, 3, 7, 7), 64, np.float32), 224), np.full((1, 3, 224, 224), 64, np.float32))


def test_a_task_of_a_tile_job_gets_hundreds_of_small_files(spark, tmp_path):
    most = spark.sparkContext.defaultParallelism
    for number in range(40 * most):
        (tmp_path / f"{number}.png").write_bytes(b"junk")
    cost = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(cost)

    @session.tile_job
    def tasks(given):
        return given.read.format("binaryFile").load(str(tmp_path)).rdd.getNumPartitions()

    assert tasks.__wrapped__(spark) > most
    assert tasks(spark) <= most and spark.conf.get(cost) == before
    for job in (train.train, retrain.retrain, score.score):
        assert job.__wrapped__
