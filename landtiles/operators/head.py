"""A linear head over features, as a product of blocked matrices.

The head is cut into tiles of ``CLASSES`` classes by ``POSITIONS`` positions, the rows into tiles of up to ``ROWS`` rows
by ``POSITIONS`` positions. A row tile meets the head tiles of its positions, each task multiplies two tiles, and
products of one row tile and class block are summed over the position blocks. Neither the head nor a list of its
classes is ever one value. A head that fits one tile is small enough for the optimizer to broadcast.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landtiles.operators.labels import add_index, index_to_label, label_index
from landtiles.session import cut

ROWS = 1024
CLASSES = 1024
POSITIONS = 1024


def linear_head(features: DataFrame, head: DataFrame, target: str = "scores", classes: int = CLASSES, positions: int = POSITIONS) -> DataFrame:
    """Add the scores ``features . w + b`` of each class, classes in sorted order.

    ``head`` has one row ``label, w, b`` per class. Features that are missing, or of another length than the
    weights, end the job, as do a head without classes and a class with two rows.
    """
    rows, _, products = _products(features, head, classes, positions)

    def unrolled(batches):
        for batch in batches:
            for part in batch.to_pylist():
                scores = np.frombuffer(part["product"]).reshape(len(part["rows"]), -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part["rows"], pa.int64()), pa.array([part["class_block"]] * len(scores), pa.int64()), pa.array(list(scores))],
                    names=["_row", "block", "part"],
                )

    parts = products.mapInArrow(unrolled, "_row bigint, block bigint, part array<double>")
    # as many parts a row as the array that is asked for has blocks
    whole = parts.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("block", "part"))).alias("parts"))
    scores = whole.select("_row", F.flatten(F.transform("parts", lambda p: p["part"])).alias(target))
    return rows.join(scores, "_row").select(*features.columns, target)


def best_of_head(features: DataFrame, head: DataFrame, classes: int = CLASSES, positions: int = POSITIONS) -> DataFrame:
    """Add ``pred_label`` and ``score`` of the class that scores highest, of equal ones the first in sorted order.

    A row needs one number and class per class block, however many classes there are.
    """
    rows, index, products = _products(features, head, classes, positions)

    def highest(batches):
        for batch in batches:
            for part in batch.to_pylist():
                scores = np.frombuffer(part["product"]).reshape(len(part["rows"]), -1)
                at = scores.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part["rows"], pa.int64()),
                        pa.array(scores[np.arange(len(scores)), at]),
                        pa.array(at + part["class_block"] * classes, pa.int64()),
                    ],
                    names=["_row", "score", "idx"],
                )

    found = products.mapInArrow(highest, "_row bigint, score double, idx bigint")
    best = found.groupBy("_row").agg(F.max(F.struct("score", (-F.col("idx")).alias("turned"))).alias("best"))
    named = index_to_label(best, -F.col("best.turned"), index, "pred_label")
    return rows.join(named.select("_row", "pred_label", F.col("best.score").alias("score")), "_row").select(
        *features.columns, "pred_label", "score"
    )


def _products(features: DataFrame, head: DataFrame, classes: int, positions: int):
    """Numbered rows, the label index, and ``rows, class_block, product`` of each row tile and class block."""
    size = head.agg(
        F.count("*").alias("n"), F.min(F.size("w")).alias("least"), F.max(F.size("w")).alias("most"), F.count_distinct("label").alias("labels")
    ).first()
    if not size.n:
        raise ValueError("a head without classes")
    if size.least != size.most or size.least < 1 or size.labels != size.n:
        raise ValueError("a head needs one row a class, all with as many weights")
    blocks = -(-size.most // positions)
    index = cut(label_index(head), "head-index")
    tiles = cut(_head_tiles(add_index(head, index), classes, positions, blocks), "head-tiles")
    rows = cut(features.withColumn("_row", F.monotonically_increasing_id()), "rows")
    class_blocks = -(-size.n // classes)
    wanted = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(class_blocks - 1).cast("bigint")))
    cut_up = _row_tiles(rows, size.most, positions).withColumn("class_block", wanted)
    products = cut_up.join(tiles, ["class_block", "position_block"]).mapInArrow(
        _multiplied, "tile bigint, class_block bigint, rows array<bigint>, product binary"
    )
    if blocks > 1:
        products = products.groupBy("tile", "class_block").applyInArrow(
            _summed, "tile bigint, class_block bigint, rows array<bigint>, product binary"
        )
    return rows, index, products


def _head_tiles(head: DataFrame, classes: int, positions: int, blocks: int) -> DataFrame:
    """``class_block, position_block, weights``: classes by positions, then one number a class that is added."""

    def tile(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        weights = np.array(table.column("w").to_pylist(), np.float64)
        bias = table.column("b").to_numpy() if table.column("position_block")[0].as_py() == 0 else np.zeros(len(table))
        made = [table.column(c)[0].as_py() for c in ("class_block", "position_block")]
        return pa.table({
            "class_block": pa.array(made[:1], pa.int64()), "position_block": pa.array(made[1:], pa.int64()),
            "n_classes": pa.array([len(table)], pa.int32()),
            "weights": pa.array([np.column_stack([weights, bias]).tobytes()], pa.binary()),
        })

    part = F.slice("w", F.col("position_block") * positions + 1, F.lit(positions)).cast("array<double>")
    cells = head.select(
        "idx", F.floor(F.col("idx") / classes).alias("class_block"), "w", F.col("b").cast("double").alias("b"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("position_block"),
    )
    cells = cells.withColumns({"w": part, "position_block": F.col("position_block").cast("bigint")})
    return cells.groupBy("class_block", "position_block").applyInArrow(
        tile, "class_block bigint, position_block bigint, n_classes int, weights binary"
    )


def _row_tiles(rows: DataFrame, width: int, positions: int) -> DataFrame:
    """``tile, position_block, rows, numbers`` of rows that lie together; a tile is named by its first row."""

    def tiles(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                lists = some.column("features").to_pylist()
                if any(x is None or len(x) != width for x in lists):
                    raise ValueError("features do not fit the head")
                numbers = np.array(lists, np.float64)
                ids = some.column("_row").to_pylist()
                starts = range(0, width, positions)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[0]] * len(starts), pa.int64()),
                        pa.array(range(len(starts)), pa.int64()),
                        pa.array([ids] * len(starts), pa.list_(pa.int64())),
                        pa.array([np.ascontiguousarray(numbers[:, s : s + positions]).tobytes() for s in starts], pa.binary()),
                    ],
                    names=["tile", "position_block", "rows", "numbers"],
                )

    kinds = "tile bigint, position_block bigint, rows array<bigint>, numbers binary"
    return rows.select("_row", "features").mapInArrow(tiles, kinds)


def _multiplied(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            pair = batch.slice(at, 1).to_pylist()[0]
            numbers = np.frombuffer(pair["numbers"]).reshape(len(pair["rows"]), -1)
            weights = np.frombuffer(pair["weights"]).reshape(pair["n_classes"], -1)
            product = numbers @ weights[:, :-1].T + weights[:, -1]
            yield pa.RecordBatch.from_pydict({
                "tile": pa.array([pair["tile"]], pa.int64()), "class_block": pa.array([pair["class_block"]], pa.int64()),
                "rows": pa.array([pair["rows"]], pa.list_(pa.int64())), "product": pa.array([product.tobytes()], pa.binary()),
            })


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(p) for p in table.column("product").to_pylist())
    first = table.slice(0, 1)
    return first.set_column(first.column_names.index("product"), "product", pa.array([total.tobytes()], pa.binary()))
