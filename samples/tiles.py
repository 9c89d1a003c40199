"""PNG tiles drawn from the rows of a given table, written by the tasks that hold the rows."""

from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landtiles.functions.vectors import hash_fraction
from landtiles.session import scratch_path
from samples.views import view

SIDE = 8


@cache
def _folder(spark_app: str, sf_dir: str, labelled: bool) -> str:
    spark = SparkSession.active()
    root = scratch_path(spark, "sample-tiles")
    pixels = view(spark, sf_dir, "tile_pixels")
    name = F.concat(F.lit("tile_"), "vec_id", F.lit(".png"))
    if labelled:
        name = F.concat(F.lit("class_"), "label", F.lit("/"), name)
    write_png(pixels.select(name.alias("name"), "r", "g", "b"), root, SIDE)
    return root


# A colour per class that brightness, contrast and saturation do not turn into another.
SHOWN = [(30, 30, 30), (30, 30, 220), (30, 220, 30), (30, 220, 220), (220, 30, 30), (220, 30, 220), (220, 220, 30),
         (220, 220, 220), (220, 125, 30), (30, 125, 220)]
TRAINED_SHARE = 0.7


@cache
def _shown(spark_app: str, sf_dir: str) -> tuple[str, str, str]:
    spark = SparkSession.active()
    root = scratch_path(spark, "shown-tiles")
    folders = f"{root}/train", f"{root}/test", f"{root}/flat"
    pixels = view(spark, sf_dir, "tile_pixels")
    name = F.concat(F.lit("tile_"), "vec_id", F.lit(".png"))
    colours = F.array(*(F.array(*map(F.lit, c)) for c in SHOWN))
    colour = colours[F.col("label").cast("int")]

    def channel(c: str, i: int):
        """A little of the tile's own pattern stays."""
        return F.transform(c, lambda v: (colour[i] + v % 12).cast("int")).alias(c)

    folder = F.concat(F.lit("class_"), "label", F.lit("/")).alias("folder")
    painted = pixels.select(name.alias("name"), folder, *(channel(c, i) for i, c in enumerate("rgb")))
    labelled = painted.withColumn("name", F.concat("folder", "name"))
    write_png(labelled.where(hash_fraction(F.substring_index("name", "/", -1)) < TRAINED_SHARE), folders[0], SIDE)
    write_png(labelled.where(hash_fraction(F.substring_index("name", "/", -1)) >= TRAINED_SHARE), folders[1], SIDE)
    write_png(painted, folders[2], SIDE)
    return folders


def shown_tiles(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """A training folder, a held-out folder and a flat folder of all tiles; pictures show their class."""
    return _shown(spark.sparkContext.applicationId, sf_dir)


def tile_folder(spark: SparkSession, sf_dir: str, labelled: bool = True) -> str:
    """Folder with one tile per row of ``embeddings``; drawn once per application."""
    return _folder(spark.sparkContext.applicationId, sf_dir, labelled)


def write_png(pixels: DataFrame, root: str, side: int) -> int:
    """Write ``name, r, g, b`` rows as RGB PNG files; a task that runs again writes the same."""

    def write(batches):
        import struct
        import zlib

        import numpy as np
        from pyarrow import fs

        target, base = fs.FileSystem.from_uri(root)

        def chunk(kind, data):
            return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

        for batch in batches:
            channels = [batch.column(c).flatten().to_numpy() for c in "rgb"]
            rows = np.stack(channels, axis=1).astype(np.uint8).reshape(-1, side, side * 3)
            lines = np.concatenate([np.zeros((len(rows), side, 1), np.uint8), rows], axis=2)
            head = chunk(b"IHDR", struct.pack(">IIBBBBB", side, side, 8, 2, 0, 0, 0))
            names = batch.column("name").to_pylist()
            for folder in {f"{base}/{name}".rsplit("/", 1)[0] for name in names}:
                target.create_dir(folder, recursive=True)
            for name, tile in zip(names, lines):
                body = chunk(b"IDAT", zlib.compress(tile.tobytes()))
                with target.open_output_stream(f"{base}/{name}") as out:
                    out.write(b"\x89PNG\r\n\x1a\n" + head + body + chunk(b"IEND", b""))
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(names)], pa.int64())})

    parts = pixels.sparkSession.sparkContext.defaultParallelism
    written = pixels.repartition(parts, "name").mapInArrow(write, "n bigint")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
