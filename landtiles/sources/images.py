"""Image tiles and file listings as DataFrames."""

import posixpath
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landtiles.functions import png
from landtiles.functions.paths import base_name, class_name, file_path
from landtiles.functions.vectors import hash_fraction
from landtiles.sinks.ledger import committed

TILES_AT_ONCE = 128  # decoded together
FEW_FILES = 1000  # names of other images that a plan may hold
MODES = {1: 0, 3: 16, 4: 24}  # fixed values: the image type of 8-bit grey, BGR and BGRA


def read_labelled_tiles(
    spark: SparkSession,
    root: str,
    fraction: float = 1.0,
    classes: str = "*",
    seen: Observation | None = None,
) -> DataFrame:
    """``filepath, label, image`` of ``<root>/<class>/<tile>.png``.

    ``classes`` is a pattern for the class folders to read.
    Files that are no images are left out; ``unreadable_tiles`` lists them, and ``seen`` counts them on the way.
    """
    key = F.concat_ws("/", class_name(file_path()), base_name(file_path()))
    tiles = _scan(spark, root, drop_invalid=seen is None, fraction=fraction, key=key, classes=classes)
    return readable(tiles, seen).select("filepath", class_name(F.col("filepath")).alias("label"), "image")


def read_flat_tiles(
    spark: SparkSession, root: str, fraction: float = 1.0, seen: Observation | None = None
) -> DataFrame:
    """``filepath, image`` of ``<root>/<tile>.png``; ``filepath`` is the file name only."""
    tiles = _scan(spark, root, drop_invalid=seen is None, fraction=fraction, key=base_name(file_path()))
    return readable(tiles, seen).select(base_name(F.col("filepath")).alias("filepath"), "image")


def read_packed_tiles(
    spark: SparkSession, path: str, fraction: float = 1.0, seen: Observation | None = None
) -> DataFrame:
    """Tiles that the job ``pack`` stored; the sample is the one the files would give."""
    tiles = committed(spark, path)
    name = base_name(F.col("filepath"))
    key = F.concat_ws("/", "label", name) if "label" in tiles.columns else name
    return readable(sampled(tiles, key, fraction), seen)


def readable(tiles: DataFrame, seen: Observation | None) -> DataFrame:
    """The tiles that decode; ``seen`` gets ``tiles_read`` and ``tiles_unreadable`` when they have been used.

    A stage that is repeated after the loss of an executor may count its tiles again.
    """
    if seen is None:
        return tiles
    decoded = F.col("image.height") >= 0
    counts = (F.count_if(decoded).alias("tiles_read"), F.count_if(~decoded).alias("tiles_unreadable"))
    return tiles.observe(seen, *counts).where(decoded)


def unreadable_tiles(spark: SparkSession, root: str, labelled: bool) -> DataFrame:
    """``filepath`` of the PNG files that do not decode."""
    tiles = _scan(spark, root, drop_invalid=False, classes="*" if labelled else None)
    return tiles.where(F.col("image.height") < 0).select("filepath")


def list_class_files(spark: SparkSession, root: str) -> DataFrame:
    """``filename, label`` of every file one folder below the root, whatever its type.

    The content column is not read.
    """
    files = spark.read.format("binaryFile").load(f"{root}/*").where(_in_class_folder(root))
    return files.select(F.col("path").alias("filename"), class_name(F.col("path")).alias("label"))


def sampled(rows: DataFrame, key: Column, fraction: float) -> DataFrame:
    """About this fraction of the rows: those whose key hashes below it.

    The same rows are chosen on every run. On a key made of the file path alone the
    choice is made while files are listed, so the others are neither read nor decoded.
    """
    if not 0.0 < fraction <= 1.0:
        raise ValueError("sampling fraction must be above 0.0 and at most 1.0")
    return rows if fraction == 1.0 else rows.where(hash_fraction(key) < fraction)


def _scan(
    spark: SparkSession,
    root: str,
    drop_invalid: bool,
    fraction: float = 1.0,
    key: Column | None = None,
    classes: str | None = None,
) -> DataFrame:
    """``filepath, image`` of the sampled files; only folders are named to the reader, which lists them on the driver.

    Spark's image reader builds an encoder for every file, which costs a small tile more than all else. Plain PNG files,
    8 bits a sample without palette, are decoded in batches by tasks; the image reader gets the others. Which
    these are is found by a first pass over the files.
    """

    def load(source: str) -> DataFrame:
        reader = spark.read.format(source).option("pathGlobFilter", "*.png")
        if source == "image":
            reader = reader.option("dropInvalid", drop_invalid)
        found = reader.load(root) if classes is None else reader.load(f"{root}/{classes}").where(_in_class_folder(root))
        return found if key is None else sampled(found, key, fraction)

    files = load("binaryFile")
    others = files.where(~_plain(F.col("content"))).select(file_path().alias("name")).limit(FEW_FILES + 1).collect()
    if len(others) > FEW_FILES:
        return load("image").select(file_path().alias("filepath"), "image")
    tiles = _decoded(files.where(_plain(F.col("content"))), spark.read.format("image").load([]).schema["image"].dataType)
    if drop_invalid:
        tiles = tiles.where("image.height >= 0")
    if not others:
        return tiles
    rest = load("image").where(file_path().isin([r.name for r in others]))  # no other file is opened
    return tiles.union(rest.select(file_path().alias("filepath"), "image"))


def _plain(content: Column) -> Column:
    """True for PNG files of grey, RGB or RGBA with 8 bits each, not interlaced and without a transparent colour."""

    def bytes_at(start: int, count: int) -> Column:
        return F.hex(F.substring(content, start, count))

    head = (bytes_at(1, 8) == F.hex(F.lit(png.SIGNATURE))) & (bytes_at(13, 4) == F.hex(F.lit(b"IHDR")))
    kind = bytes_at(25, 2).isin("0800", "0802", "0806") & (bytes_at(29, 1) == "00")
    return head & kind & ~F.contains(content, F.lit(b"tRNS"))


def _decoded(files: DataFrame, image: StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TILES_AT_ONCE):
                part = batch.slice(start, TILES_AT_ONCE)
                tiles = png.decoded(part.column("content").to_pylist())
                shapes = [(-1, -1, -1) if t is None else t.shape for t in tiles]
                sizes = [pa.array(v, pa.int32()) for v in zip(*shapes)]
                modes = pa.array([MODES.get(shape[2], -1) for shape in shapes], pa.int32())
                data = pa.array([b"" if t is None else t.tobytes() for t in tiles], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("filepath"), part.column("origin"), *sizes, modes, data], names=["filepath", *image.names]
                )

    # the image reader names a place without a host with three slashes
    origin = F.regexp_replace(F.col("_metadata.file_path"), "^([A-Za-z][A-Za-z0-9+.-]*):/(?!/)", "$1:///")
    rows = files.select(file_path().alias("filepath"), origin.alias("origin"), "content")
    flat = StructType([rows.schema["filepath"], *image.fields])
    return rows.mapInArrow(run, flat).select("filepath", F.struct(*image.names).alias("image"))


def _in_class_folder(root: str) -> Column:
    """True for files exactly one folder below the root, not for files in the root itself."""
    if re.search(r"[*?\[\]{}]", root):
        raise ValueError(f"a root is one folder, not a pattern: {root}")
    # hdfs:/data, hdfs://host/data and /data all end in the same folder
    plain = posixpath.normpath(re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*(?=/))?", "", root))
    while plain.startswith("../"):
        plain = plain[3:]
    folder = F.regexp_replace(file_path(), "/+[^/]+/+[^/]+$", "")
    return folder.endswith("/" + plain.strip("/"))
