"""Image tiles to feature vectors or class scores, one pass per Arrow batch."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StructField, StructType

from landtiles.fixed import PIXEL_MEAN, TILE_SIDE
from landtiles.functions import pixels
from landtiles.functions.paths import base_name, class_name
from landtiles.functions.vectors import hash_fraction

# Tiles held as floats at once inside a task: 64 x 3 x 224 x 224 x 4 bytes are 39 MB.
TILES_AT_ONCE = 64
_IMAGE_FIELDS = ("origin", "height", "width", "nChannels", "data")
_DRAWS = ("top", "left", "brightness", "contrast", "saturation")


class BlockFeatures:
    """Features without a network: means of ``blocks`` x ``blocks`` areas and value histograms.

    ``mean`` is what was taken off the pixels before.
    """

    tiles_at_once = 4  # what a core's cache holds

    def __init__(self, blocks: int = 8, bins: int = 8, mean: float = PIXEL_MEAN):
        self.blocks, self.bins, self.mean = blocks, bins, mean

    def __call__(self, tiles: np.ndarray) -> np.ndarray:
        n, channels, side, _ = tiles.shape
        edges = np.arange(self.blocks) * side // self.blocks
        sizes = np.diff(edges, append=side)
        lines = [tiles[:, :, at : at + size].sum(axis=2) for at, size in zip(edges, sizes)]
        sums = np.add.reduceat(np.stack(lines, axis=2), edges, axis=3)
        means = sums / np.multiply.outer(sizes, sizes).astype(np.float32)
        held = np.empty((side, side), np.float32), np.empty((side, side), np.uint8), np.empty((side, side), bool)
        counts = [self._counts(channel, *held) for tile in tiles for channel in tile]
        shares = np.array(counts).reshape(n, channels, self.bins) / side**2
        return np.concatenate([means.reshape(n, -1), shares.reshape(n, -1)], axis=1)

    def _counts(self, channel: np.ndarray, values: np.ndarray, slots: np.ndarray, same: np.ndarray) -> list[int]:
        """How many values of a channel, which a core's cache holds, are in each bin; the last three are overwritten."""
        np.add(channel, np.float32(self.mean), out=values)
        np.multiply(values, np.float32(self.bins / 256), out=values)
        slots[...] = values  # cut to whole numbers
        return [np.count_nonzero(np.equal(slots, np.uint8(b), out=same)) for b in range(self.bins)]


class OnnxNetwork:
    """A network file, broadcast to the executors; ``output`` names the layer to return.

    Without a name the first output is returned. Each Python worker opens one session.
    A network built for a fixed batch size gets its last batch filled up with zeros.
    """

    _opened: dict = {}

    def __init__(self, spark: SparkSession, path: str, output: str | None = None):
        files = spark.read.format("binaryFile").load(path).limit(2).collect()
        if len(files) != 1:
            raise ValueError(f"one network file is needed, not {'several' if files else 'none'}: {path}")
        content = bytes(files[0].content)
        self.key = hashlib.md5(content).hexdigest()
        self.content = spark.sparkContext.broadcast(content)
        self.output = output

    def _session(self):
        if self.key not in OnnxNetwork._opened:
            import onnxruntime

            options = onnxruntime.SessionOptions()
            options.intra_op_num_threads = 1  # Spark runs one task per core
            session = onnxruntime.InferenceSession(
                self.content.value, options, providers=["CPUExecutionProvider"]
            )
            OnnxNetwork._opened = {self.key: session}
        return OnnxNetwork._opened[self.key]

    def __call__(self, tiles: np.ndarray) -> np.ndarray:
        session = self._session()
        source = session.get_inputs()[0]
        wanted = [self.output or session.get_outputs()[0].name]
        shape = [d if isinstance(d, int) else None for d in source.shape]
        batched = len(shape) == 4 or len(shape) == 2
        size = shape[0] if batched else 1
        found = []
        for start in range(0, len(tiles), size or len(tiles)):
            part = tiles[start : start + (size or len(tiles))]
            full = part
            if size and len(part) < size:
                filler = np.zeros((size - len(part),) + part.shape[1:], part.dtype)
                full = np.concatenate([part, filler])
            if len(shape) == 2:
                full = full.reshape(len(full), -1)
            result = session.run(wanted, {source.name: full if batched else full[0]})[0]
            found.append(np.asarray(result).reshape(len(full), -1)[: len(part)])
        return np.concatenate(found)


def featurize(
    tiles: DataFrame,
    extractor=None,
    side: int = TILE_SIDE,
    mean: float = PIXEL_MEAN,
    epoch: Column | None = None,
    seed: str = "0",
    epochs: int | None = None,
    epoch_column: str | None = None,
) -> DataFrame:
    """Replace ``image`` by ``features``, an array of floats.

    A tile is scaled to ``side`` if it differs, unrolled to channel-height-width order
    with channels blue, green, red, less ``mean``, and handed to the extractor. With an
    ``epoch`` it is cropped and its colours are changed first, as in training. With a number
    of ``epochs`` each tile gives one row per epoch, from 1; its bytes are handed over once, and
    the number of the epoch is in ``epoch_column`` if one is named.
    """
    extractor = extractor or BlockFeatures()
    passes = [F.lit(e) for e in range(1, epochs + 1)] if epochs else [] if epoch is None else [epoch]
    kept = [c for c in tiles.columns if c != "image"]
    flat = _flat(tiles, kept, passes, seed)
    turns = range(len(passes)) if passes else [None]
    numbered = [epoch_column] if epoch_column and epochs else []
    schema = StructType(
        [flat.schema[c] for c in kept]
        + [StructField("features", ArrayType(FloatType(), False))]
        + [StructField(c, IntegerType()) for c in numbered]
    )

    few = min(TILES_AT_ONCE, getattr(extractor, "tiles_at_once", TILES_AT_ONCE))

    def features(batches):
        ready = np.empty((few, 3, side, side), np.float32)
        for batch in batches:
            for start in range(0, batch.num_rows, TILES_AT_ONCE):
                part = batch.slice(start, TILES_AT_ONCE)
                pieces = [part.slice(at, few) for at in range(0, part.num_rows, few)]
                unrolled = [(piece, list(pixels.stacks(piece))) for piece in pieces]
                for turn in turns:
                    found = []
                    for piece, stacks in unrolled:
                        tiles = ready[: piece.num_rows]
                        for rows, stack in stacks:
                            made = _prepared(piece, rows, stack, side, turn)
                            if len(stacks) == 1:
                                tiles = made  # all rows, in order
                            else:
                                tiles[rows] = made
                        tiles -= np.float32(mean)
                        found.append(extractor(tiles).astype(np.float32))
                    number = [pa.array([turn + 1] * part.num_rows, pa.int32()) for _ in numbered]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(c) for c in kept] + [_lists(np.concatenate(found))] + number,
                        names=kept + ["features"] + numbered,
                    )

    return flat.mapInArrow(features, schema)


def augment(tiles: DataFrame, epoch: Column, seed: str = "0", side: int = TILE_SIDE) -> DataFrame:
    """Training form of each tile as an image again: cropped, scaled, colours changed."""
    kept = [c for c in tiles.columns if c != "image"]
    image = tiles.schema["image"].dataType
    flat = _flat(tiles, kept, [epoch], seed)
    names = [f.name for f in image.fields]
    schema = StructType(
        [tiles.schema[c] for c in kept] + [StructField(f"_{f.name}", f.dataType) for f in image.fields]
    )
    opencv_three_bytes = 16  # image type of three unsigned bytes per pixel

    def images(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, TILES_AT_ONCE):
                part = batch.slice(start, TILES_AT_ONCE)
                data = np.empty((part.num_rows, side, side, 3), np.uint8)
                for rows, stack in pixels.stacks(part):
                    data[rows] = np.rint(_prepared(part, rows, stack, side, 0)).transpose(0, 2, 3, 1)
                n = part.num_rows
                made = {
                    "origin": part.column("_origin"),
                    "height": pa.array([side] * n, pa.int32()),
                    "width": pa.array([side] * n, pa.int32()),
                    "nChannels": pa.array([3] * n, pa.int32()),
                    "mode": pa.array([opencv_three_bytes] * n, pa.int32()),
                    "data": pa.array([tile.tobytes() for tile in data], pa.binary()),
                }
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [made[c] for c in names], names=schema.names
                )

    return flat.mapInArrow(images, schema).select(
        *kept, F.struct(*(F.col(f"_{c}").alias(c) for c in names)).alias("image")
    )


def draws(epoch: Column, seed: str = "0") -> list[Column]:
    """Five numbers in [0, 1) per tile that follow from its class, name, epoch and seed.

    A task that runs again draws the same numbers.
    """
    tile = F.concat_ws("/", class_name(F.col("filepath")), base_name(F.col("filepath")))
    return [
        hash_fraction(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.lit(name), tile)).alias(name)
        for name in _DRAWS
    ]


def _flat(tiles: DataFrame, kept: list[str], passes: list[Column], seed: str) -> DataFrame:
    """The fields of the image, and for each kind of draw the numbers of all passes."""
    fields = [F.col(f"image.{c}").alias(f"_{c}") for c in _IMAGE_FIELDS]
    drawn = zip(*(draws(epoch, seed) for epoch in passes))
    return tiles.select(*kept, *fields, *(F.array(*c).alias(f"_{d}") for c, d in zip(drawn, _DRAWS)))


def _prepared(part: pa.RecordBatch, rows, stack: np.ndarray, side: int, turn: int | None) -> np.ndarray:
    """Tiles as the extractor takes them, but for the mean; ``turn`` is the pass whose draws change them."""
    if turn is None:
        return pixels.resize(pixels.unroll(stack), side)
    drawn = [part.column(f"_{d}").flatten().to_numpy().reshape(part.num_rows, -1) for d in _DRAWS]
    drawn = np.stack([d[rows, turn] for d in drawn], axis=1)
    return pixels.jitter_resized(pixels.unroll(pixels.crop(stack, drawn[:, :2])), drawn[:, 2:], side)


def _lists(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))
