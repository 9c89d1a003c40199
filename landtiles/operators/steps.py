"""Training of dense layers on stored features in synchronous steps, one epoch at a time; a restart goes on.

Features are packed once into blocks of rows, keyed by epoch and step. A large step reads its own blocks only: tasks sum
the gradients of their blocks, the sums meet in pieces of the weights, and the driver, which holds the weights, moves them.
Small steps cost less than the start of a job, and each waits for the one before: a task takes the weights, makes a run of
them in order, of ``RUN_ROWS`` rows at most, and hands the weights on. Both ways give the same weights to the bit.
Gradients are summed as whole numbers of ``UNIT``, so neither the layout of tasks nor one that runs again changes a bit.
After each epoch weights and moments are written; a run that was killed starts behind the last epoch written. A table
of runs has the settings of each and whether it ended; only one that did not is gone on with.

A weight moves by its mean gradient with momentum, over the root of the mean squared gradient. Rates are per row, so a
step moves weights by the rate times its rows. Rows of an epoch are dealt to steps by a hash of their name.
"""

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landtiles.fixed import LAST_LAYER_L2, MOMENTUM_ROWS, ROW_RATES
from landtiles.operators.labels import add_index

UNIT = 2.0**-28
PIECE = 4096  # weights whose gradients meet in one group
SEED = 20171
RUN_ROWS = 1 << 16  # rows of the steps that one task makes in a row
SMALL_STEP_ROWS = 4096  # steps of more rows are made by many tasks
BLOCKS = "epoch int, run int, step int, rows int, labels binary, features binary"
MOVED = "weights binary, speed binary, square binary, rows bigint, loss bigint, errors bigint"
RUNS = "run string, settings string, at timestamp, ended boolean"
STATE = "layers array<int>, mean binary, scale binary, weights binary, speed binary, square binary, rows bigint, loss double, errors bigint"


@dataclass(frozen=True)
class Plan:
    """How a set of features is trained on. ``rates`` are pairs of a rate per row and its last epoch (None: no end)."""

    epochs: int
    hidden: tuple[int, ...] = ()
    step_rows: int = 256
    block_rows: int = 256
    rates: tuple = ROW_RATES
    momentum_rows: int = MOMENTUM_ROWS
    l2: float = LAST_LAYER_L2
    seed: int = SEED
    run_rows: int = RUN_ROWS

    @property
    def run_steps(self) -> int:
        """Steps that one task makes in a row."""
        return 1 if self.step_rows > min(SMALL_STEP_ROWS, self.run_rows) else self.run_rows // self.step_rows

    def rate(self, epoch: int) -> float:
        return next(rate for rate, last in self.rates if last is None or epoch <= last)


@dataclass(frozen=True)
class State:
    """Weights after an epoch, layer by layer: the matrix (to, from) column by column, then the biases."""

    layers: list[int]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    speed: np.ndarray
    square: np.ndarray
    rows: int = 0
    loss: float = 0.0
    errors: int = 0


def matrices(layers: list[int], weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of the weights as matrix and bias of each layer."""
    found, at = [], 0
    for into, out in zip(layers[:-1], layers[1:]):
        found.append((weights[at : at + into * out].reshape((out, into), order="F"), weights[at + into * out :][:out]))
        at += (into + 1) * out
    return found


def first_weights(layers: list[int], seed: int) -> np.ndarray:
    """Uniform weights within the root of 6 over a layer's sizes; no bias."""
    draw = np.random.default_rng(seed)
    weights = np.zeros(sum((i + 1) * o for i, o in zip(layers[:-1], layers[1:])))
    for matrix, _ in matrices(layers, weights):
        bound = np.sqrt(6 / sum(matrix.shape))
        matrix[...] = draw.uniform(-bound, bound, matrix.shape)
    return weights


def gradient(layers: list[int], weights: np.ndarray, x: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float, int]:
    """The summed gradient of the cross entropy over some rows, the summed loss, and how many rows are wrong."""
    known, values = matrices(layers, weights), [x]
    for matrix, bias in known[:-1]:
        values.append(1 / (1 + np.exp(-np.clip(values[-1] @ matrix.T + bias, -40, 40))))
    scores = values[-1] @ known[-1][0].T + known[-1][1]
    scores -= scores.max(axis=1, keepdims=True)
    share = np.exp(scores)
    share /= share.sum(axis=1, keepdims=True)
    at = np.arange(len(labels))
    loss, errors = -np.log(np.maximum(share[at, labels], 1e-300)).sum(), int((share.argmax(axis=1) != labels).sum())
    share[at, labels] -= 1
    total = np.zeros(len(weights))
    back = share
    for (matrix, bias), value, (upper, _) in zip(matrices(layers, total)[::-1], values[::-1], known[::-1]):
        matrix[...] = back.T @ value
        bias[...] = back.sum(axis=0)
        back = (back @ upper) * value * (1 - value)
    return total, loss, errors


def pack_steps(features: DataFrame, index: DataFrame, plan: Plan, path: str) -> None:
    """Write ``filepath, label, epoch, features`` as blocks of rows, in folders by epoch and run of steps."""
    rows = add_index(features, index)
    most = rows.groupBy("epoch").count().agg(F.max("count")).first()[0]
    steps = max(1, -(-most // plan.step_rows))
    key = F.xxhash64(F.lit(plan.seed), "epoch", "filepath")
    dealt = rows.select("epoch", F.pmod(key, F.lit(steps)).cast("int").alias("step"), key.alias("key"), "filepath", "idx", "features")
    # rows of a step are dealt on by further digits of the hash; blocks close at their size, so no group is held whole
    part = F.pmod(F.shiftrightunsigned("key", 32), F.lit(max(1, plan.step_rows // plan.block_rows))).cast("int")
    order = ["epoch", "step", "part"]
    run_number = F.floor(F.col("step") / plan.run_steps).cast("int")
    placed = dealt.withColumn("part", part).withColumn("run", run_number)
    placed = placed.repartition("epoch", "run", *(["part"] if plan.run_steps == 1 else []))
    placed = placed.sortWithinPartitions("epoch", "run", "step", "part", "key", "filepath", "features")

    def block(held: list[tuple], at: tuple) -> pa.RecordBatch:
        labels, values = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        row = (at[0], at[1] // plan.run_steps, at[1], len(labels), labels.astype("<i4").tobytes(), values.astype("<f4").tobytes())
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        names = ["epoch", "run", "step", "rows", "labels", "features"]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, now = [], 0, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in order], axis=1)
            labels = batch.column("idx").to_numpy()
            values = batch.column("features").flatten().to_numpy().reshape(len(labels), -1)
            edges = np.append(np.flatnonzero(np.append(True, (np.diff(keys, axis=0) != 0).any(axis=1))), len(keys)).tolist()
            for start, end in zip(edges[:-1], edges[1:]):
                if held and tuple(keys[start]) != now:
                    yield block(held, now)
                    held, size = [], 0
                now = tuple(keys[start].tolist())
                while start < end:
                    to = min(end, start + plan.block_rows - size)
                    held.append((labels[start:to], values[start:to]))
                    size, start = size + to - start, to
                    if size == plan.block_rows:
                        yield block(held, now)
                        held, size = [], 0
        if held:
            yield block(held, now)

    placed.mapInArrow(run, BLOCKS).write.mode("overwrite").partitionBy("epoch", "run").parquet(path)


def block_sum(layers: list[int], weights: np.ndarray, mean: np.ndarray, scale: np.ndarray, labels: bytes, values: bytes) -> tuple:
    """The gradient of a block and its loss as whole numbers of ``UNIT``; its rows and errors."""
    labels = np.frombuffer(labels, "<i4")
    x = (np.frombuffer(values, "<f4").reshape(len(labels), -1) - mean) / scale
    found, lost, wrong = gradient(layers, weights, x, labels)
    return np.rint(found / UNIT).astype(np.int64), len(labels), int(np.rint(lost / UNIT)), wrong


def summed(blocks: DataFrame, state: State) -> tuple[np.ndarray, int, float, int]:
    """The gradient summed over all rows of the blocks; how many rows, their loss and errors."""
    sent = blocks.sparkSession.sparkContext.broadcast((state.layers, state.weights, state.mean, state.scale))
    size = len(state.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layers, weights, mean, scale = sent.value
        total, rows, loss, errors = np.zeros(size, np.int64), 0, 0, 0
        for batch in batches:
            for labels, values in zip(batch.column("labels").to_pylist(), batch.column("features").to_pylist()):
                found, count, lost, wrong = block_sum(layers, weights, mean, scale, labels, values)
                total += found
                rows, loss, errors = rows + count, loss + lost, errors + wrong
        if rows:
            pieces = [total[at : at + PIECE].tobytes() for at in range(0, size, PIECE)]
            counts = np.array([rows, loss, errors], np.int64).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1, *range(len(pieces))], pa.int32()), pa.array([counts, *pieces], pa.binary())], names=["piece", "numbers"]
            )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.int64) for b in table.column("numbers").to_pylist())
        return pa.table({"piece": table.column("piece").slice(0, 1), "numbers": pa.array([total.tobytes()], pa.binary())})

    schema = "piece int, numbers binary"
    found = dict(blocks.select("labels", "features").mapInArrow(run, schema).groupBy("piece").applyInArrow(add, schema).collect())
    sent.destroy()
    rows, loss, errors = np.frombuffer(found.pop(-1), np.int64).tolist()
    total = np.concatenate([np.frombuffer(found[k], np.int64) for k in sorted(found)])
    return total * UNIT, rows, loss * UNIT, errors


def steps_in_a_row(blocks: DataFrame, state: State, plan: Plan, epoch: int) -> tuple[State, int, float, int]:
    """The state after the steps of one run, made in order by one task; rows, loss and errors of all of them."""
    sent = blocks.sparkSession.sparkContext.broadcast(state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, total, rows, counts = sent.value, None, 0, 0, np.zeros(3, np.int64)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("step", "labels", "features"))
            for step, labels, values in zip(*columns):
                if rows and step != at:
                    now, total, rows = moved(now, total * UNIT, rows, plan, epoch), 0, 0
                found, *numbers = block_sum(now.layers, now.weights, now.mean, now.scale, labels, values)
                at, total, rows, counts = step, total + found, rows + numbers[0], counts + numbers
        if rows:
            now = moved(now, total * UNIT, rows, plan, epoch)
            made = [v.astype("<f8").tobytes() for v in (now.weights, now.speed, now.square)]
            arrays = [pa.array([v], pa.binary()) for v in made] + [pa.array([int(v)], pa.int64()) for v in counts]
            yield pa.RecordBatch.from_arrays(arrays, names=["weights", "speed", "square", "rows", "loss", "errors"])

    ordered = blocks.select("step", "labels", "features").coalesce(1).sortWithinPartitions("step")
    row = ordered.mapInArrow(run, MOVED).first()
    sent.destroy()
    weights, speed, square = (np.frombuffer(row[c], "<f8") for c in ("weights", "speed", "square"))
    return replace(state, weights=weights, speed=speed, square=square), row.rows, row.loss * UNIT, row.errors


def moved(state: State, total: np.ndarray, rows: int, plan: Plan, epoch: int) -> State:
    """The state after one step."""
    mean = total / rows
    for (matrix, _), (own, _) in zip(matrices(state.layers, mean), matrices(state.layers, state.weights)):
        matrix += plan.l2 * own
    keep = np.exp(-rows / plan.momentum_rows)
    speed = keep * state.speed + (1 - keep) * mean
    square = 0.9 * state.square + 0.1 * mean**2
    weights = state.weights - plan.rate(epoch) * rows * speed / (np.sqrt(square) + 1e-8)
    return replace(state, weights=weights, speed=speed, square=square)


def first_state(features: DataFrame, classes: int, plan: Plan) -> State:
    """Weights before any step, and the mean and spread by which features are scaled."""
    vector = array_to_vector("features")
    found = features.agg(Summarizer.metrics("mean", "std").summary(vector).alias("s")).select("s.mean", "s.std").first()
    mean, spread = (np.asarray(v.toArray(), np.float32).astype(float) for v in found)
    layers = [len(mean), *plan.hidden, classes]
    weights = first_weights(layers, plan.seed)
    return State(layers, mean, np.where(spread > 0, spread, 1.0), weights, np.zeros(len(weights)), np.zeros(len(weights)))


def write_state(spark: SparkSession, state: State, path: str, epoch: int) -> None:
    numbers = [np.asarray(v, "<f8").tobytes() for v in (state.mean, state.scale, state.weights, state.speed, state.square)]
    row = (state.layers, *numbers, state.rows, state.loss, state.errors)
    spark.createDataFrame([row], STATE).coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def stored_rows(spark: SparkSession, schema: str, path: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def last_state(spark: SparkSession, path: str) -> tuple[int, State] | None:
    """The last epoch written and the state after it."""
    row = stored_rows(spark, STATE + ", epoch int", f"{path}/states").orderBy(F.desc("epoch")).first()
    if row is None:
        return None
    numbers = [np.frombuffer(row[c], "<f8") for c in ("mean", "scale", "weights", "speed", "square")]
    return row.epoch, State(list(row.layers), *numbers, row.rows, row.loss, row.errors)


def enter_run(spark: SparkSession, root: str, run: str, settings: str, ended: bool) -> None:
    row = spark.createDataFrame([(run, settings, ended)], "run string, settings string, ended boolean")
    row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/runs")


def open_run(spark: SparkSession, root: str, settings: str) -> str:
    """The last run of these settings that has not ended, or a new one."""
    runs = stored_rows(spark, RUNS, f"{root}/runs").where(F.col("settings") == settings)
    left = runs.groupBy("run").agg(F.max("ended").alias("ended"), F.min("at").alias("at")).where("not ended")
    row = left.orderBy(F.desc("at"), "run").first()
    if row:
        return row.run
    run = uuid.uuid4().hex
    enter_run(spark, root, run, settings, False)
    return run


def train_steps(features: DataFrame, index: DataFrame, plan: Plan, path: str) -> PipelineModel:
    """Train on stored ``filepath, label, epoch, features``; what a killed run of the same plan left in ``path`` is used.

    Epochs count from 1. ``index`` is the label index. The result adds ``pred_label`` as text.
    """
    spark = features.sparkSession
    labels = [r.label for r in index.orderBy("idx").collect()]  # a model has them anyway
    found = last_state(spark, path)
    if found is None:
        pack_steps(features, index, plan, f"{path}/blocks")
        found = 0, first_state(features.where("epoch = 1"), len(labels), plan)
        write_state(spark, found[1], f"{path}/states", 0)
    done, state = found
    for epoch in range(done + 1, plan.epochs + 1):
        state = run_epoch(spark, f"{path}/blocks/epoch={epoch}", state, plan, epoch)
        write_state(spark, state, f"{path}/states", epoch)
    return as_model(spark, state, labels)


def run_epoch(spark: SparkSession, path: str, state: State, plan: Plan, epoch: int) -> State:
    """The state after all steps of an epoch; a run of steps lists and reads its own folder only."""
    schema = "step int, rows int, labels binary, features binary"
    runs = sorted(r.run for r in spark.read.schema(schema + ", run int").parquet(path).select("run").distinct().collect())
    seen, loss, errors = 0, 0.0, 0
    for run in runs:
        blocks = spark.read.schema(schema).parquet(f"{path}/run={run}")
        if plan.run_steps > 1:
            state, rows, lost, wrong = steps_in_a_row(blocks, state, plan, epoch)
        else:
            total, rows, lost, wrong = summed(blocks, state)
            state = moved(state, total, rows, plan, epoch)
        seen, loss, errors = seen + rows, loss + lost, errors + wrong
    return replace(state, rows=seen, loss=loss, errors=errors)


def epoch_losses(spark: SparkSession, path: str) -> DataFrame:
    """``metric, series``: the mean loss and the errors per hundred of each epoch that is done, in order of epochs."""
    states = stored_rows(spark, STATE + ", epoch int", f"{path}/states").where("epoch > 0")
    kinds = {"training_loss": F.col("loss"), "training_error_pct": 100.0 * F.col("errors")}
    each = F.array(*(F.struct(F.lit(m).alias("metric"), (c / F.col("rows")).alias("value")) for m, c in kinds.items()))
    values = states.select("epoch", F.inline(each))
    series = F.transform(F.array_sort(F.collect_list(F.struct("epoch", "value"))), lambda p: p["value"])
    return values.groupBy("metric").agg(series.alias("series"))


def as_model(spark: SparkSession, state: State, labels: list[str]) -> PipelineModel:
    """The weights as a stored kind of model: a fit of no iterations that starts from them, on one row a class."""
    weights = state.weights.copy()
    matrix, bias = matrices(state.layers, weights)[0]
    matrix /= state.scale  # scaling of features goes into the first layer
    bias -= matrix @ state.mean
    rows = [(Vectors.dense(state.mean), float(i)) for i in range(len(labels))]
    fitted = MultilayerPerceptronClassifier(
        layers=state.layers, initialWeights=Vectors.dense(weights), maxIter=0, solver="gd",
        featuresCol="vector", labelCol="label_idx", predictionCol="pred_idx",
    ).fit(spark.createDataFrame(rows, ["vector", "label_idx"]))
    return PipelineModel(stages=[fitted, IndexToString(inputCol="pred_idx", outputCol="pred_label", labels=labels)])
