"""Tiles by manifest: a stored table of file names is what a read is planned from, not a listing of folders.

A manifest is a Parquet table of distinct names below a root (``tile.png`` or ``class/tile.png``), sorted, in row groups
of ``RANGE_NAMES``. Each row group is one partition of the source: the driver reads the footers of the manifest's
files, a task reads its names and opens those files. Names come from a tile index, or from folders that tasks list.
"""

import hashlib
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from landtiles.functions import png
from landtiles.functions.files import file_names, folder_names, opened

RANGE_NAMES = 4096
TILES_AT_ONCE = 128  # decoded together
IMAGE = "image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
MODES = {1: 0, 3: 16, 4: 24}  # fixed values: the image type of 8-bit grey, BGR and BGRA
INVALID = {"height": -1, "width": -1, "nChannels": -1, "mode": -1, "data": b""}


# ---- manifests


def names_in(spark: SparkSession, root: str, labelled: bool, pattern: str = "*.png", classes: str = "*") -> DataFrame:
    """``name`` of the files right in the root, or one class folder below it; tasks do the listing.

    Each class folder is listed by a task of its own. Names that start with ``_`` or ``.`` are no tiles.
    """

    def folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column("root").to_pylist():
                found = folder_names(place, classes) if labelled else [""]
                yield pa.RecordBatch.from_pydict({"folder": pa.array(found, pa.string())})

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                for names in file_names(root, folder, pattern):
                    yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})

    start = spark.createDataFrame([(root,)], "root string")
    return start.mapInArrow(folders, "folder string").repartition("folder").mapInArrow(files, "name string")


def names_of(paths: DataFrame, column: str, labelled: bool) -> DataFrame:
    """``name`` from a column of paths, such as the file names of a tile index."""
    path: Column = F.col(column)
    return paths.select(F.substring_index(path, "/", -2 if labelled else -1).alias("name"))


def write_manifest(names: DataFrame, path: str, range_names: int = RANGE_NAMES) -> None:
    """Store distinct names in order; a path that exists is replaced."""
    rows = names.select("name").where("name is not null").distinct().orderBy("name")
    rows.write.option("parquet.block.row.count.limit", range_names).mode("overwrite").parquet(path)


# ---- the source


@dataclass
class Names(InputPartition):
    """A row group of a manifest file."""

    file: str
    group: int

    def __post_init__(self):
        self.value = (self.file, self.group)


class TileManifest(DataSource):
    """``spark.read.format("tile_manifest")`` with options ``manifest`` and ``root``.

    Rows are ``filepath, label, image``, without ``label`` unless ``labelled`` is true (``filepath`` is then the file
    name only), and without ``image`` if ``content`` is false. ``fraction`` chooses names as the listing readers do.
    ``first`` and ``last`` bound the ranges that are read, by number. ``invalid`` keeps files that do not decode, with a
    height of -1. A name without a file ends the job.
    """

    @classmethod
    def name(cls) -> str:
        return "tile_manifest"

    def schema(self) -> str:
        flags = self.options
        columns = ["filepath string"]
        if flags.get("labelled", "false") == "true":
            columns.append("label string")
        if flags.get("content", "true") == "true":
            columns.append(IMAGE)
        return ", ".join(columns)

    def reader(self, schema) -> "TileReader":
        return TileReader(dict(self.options))


class TileReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.manifest, self.root = options["manifest"], options["root"].rstrip("/")
        self.labelled = options.get("labelled", "false") == "true"
        self.content = options.get("content", "true") == "true"
        self.invalid = options.get("invalid", "false") == "true"
        self.fraction = float(options.get("fraction", "1.0"))
        self.first, self.last = int(options.get("first", "0")), int(options.get("last", "-1"))

    def partitions(self) -> list[Names]:
        ranges = manifest_ranges(self.manifest)
        return ranges[self.first : None if self.last < 0 else self.last] or [Names("", -1)]

    def read(self, partition: Names) -> Iterator[pa.RecordBatch]:
        if partition.group < 0:
            return
        system, _ = opened(self.manifest)
        with system.open_input_file(partition.file) as source:
            names = pq.ParquetFile(source).read_row_group(partition.group, ["name"]).column("name").to_pylist()
        names = [n for n in names if self._sampled(n)]
        files, base = opened(self.root)
        for at in range(0, len(names), TILES_AT_ONCE):
            some = names[at : at + TILES_AT_ONCE]
            columns = {"filepath": pa.array([f"{self.root}/{n}" if self.labelled else posixpath.basename(n) for n in some])}
            if self.labelled:
                columns["label"] = pa.array([n.split("/")[-2] for n in some])
            batch = pa.RecordBatch.from_pydict(columns)
            if self.content:
                images = [self._image(n, t) for n, t in zip(some, png.decoded([_bytes(files, base, n) for n in some]))]
                keep = pa.array([self.invalid or i["height"] >= 0 for i in images])
                batch = batch.append_column("image", pa.array(images, _IMAGE_TYPE)).filter(keep)
            yield batch

    def _sampled(self, name: str) -> bool:
        return int(hashlib.md5(name.encode()).hexdigest()[:8], 16) / 2**32 < self.fraction

    def _image(self, name: str, tile) -> dict:
        origin = {"origin": f"{self.root}/{name}"}
        if tile is None:
            return origin | INVALID
        height, width, channels = tile.shape
        return origin | {"height": height, "width": width, "nChannels": channels, "mode": MODES[channels], "data": tile.tobytes()}


_IMAGE_TYPE = pa.struct([
    ("origin", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("nChannels", pa.int32()), ("mode", pa.int32()),
    ("data", pa.binary()),
])


def _bytes(system: fs.FileSystem, base: str, name: str) -> bytes:
    with system.open_input_stream(f"{base}/{name}") as source:
        return source.read()


def manifest_ranges(manifest: str) -> list[Names]:
    """The ranges of names of a manifest in order, from the footers of its files."""
    system, base = opened(manifest)
    infos = system.get_file_info(fs.FileSelector(base))
    files = sorted(i.path for i in infos if i.type == fs.FileType.File and i.base_name.startswith("part-"))
    found = []
    for file in files:
        with system.open_input_file(file) as source:
            found += [Names(file, group) for group in range(pq.ParquetFile(source).num_row_groups)]
    return found


def read_manifest(spark: SparkSession, manifest: str, root: str, labelled: bool, **options) -> DataFrame:
    """The tiles that a manifest names below a root; further options as ``TileManifest`` tells."""
    spark.dataSource.register(TileManifest)
    text = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}
    return (
        spark.read.format("tile_manifest").options(manifest=manifest, root=root, labelled=str(labelled).lower(), **text).load()
    )
