"""Tiles by manifest, and their packing in passes that may be cut short."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landtiles.functions import files, png
from landtiles.plans import pack as packing
from landtiles.sinks.ledger import enter, read_ledger
from landtiles.sources import images, manifest

RNG = np.random.default_rng(11)


def png_file(lines: np.ndarray, width: int, height: int, depth: int, colour: int, *extra: bytes, cut: int = 1, interlaced: int = 0) -> bytes:
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, interlaced))
    body = zlib.compress(lines.tobytes())
    parts = [body[: len(body) // cut], body[len(body) // cut :]]
    return png.SIGNATURE + head + b"".join(extra) + b"".join(chunk(b"IDAT", p) for p in parts) + chunk(b"IEND", b"")


def filtered(raw: np.ndarray, step: int, kinds: list[int]) -> np.ndarray:
    """Each line of bytes with a filter, byte by byte."""
    height, width = raw.shape
    out = np.zeros((height, width + 1), np.uint8)
    for y in range(height):
        out[y, 0] = kinds[y % len(kinds)]
        for x in range(width):
            a = int(raw[y, x - step]) if x >= step else 0
            b = int(raw[y - 1, x]) if y else 0
            c = int(raw[y - 1, x - step]) if y and x >= step else 0
            p = a + b - c
            near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            guess = [0, a, b, (a + b) // 2, near][out[y, 0]]
            out[y, x + 1] = (int(raw[y, x]) - guess) % 256
    return out


@pytest.mark.parametrize("colour, channels", [(0, 1), (2, 3), (4, 2), (6, 4)])
@pytest.mark.parametrize("kinds", [[0], [1], [2], [3], [4], [4, 3, 2, 1, 0]])
def test_filters_by_the_byte(colour, channels, kinds):
    raw = RNG.integers(0, 256, (7, 5 * channels), dtype=np.uint8)
    tile = raw.reshape(7, 5, channels)
    whole = png_file(filtered(raw, channels, kinds), 5, 7, 8, colour, cut=2)
    found, junk, again = png.decoded([whole, b"junk", whole])
    wanted = tile[..., {1: [0], 3: [2, 1, 0], 2: [0, 0, 0, 1], 4: [2, 1, 0, 3]}[channels]]
    assert junk is None and np.array_equal(found, wanted) and np.array_equal(again, wanted)


def test_depths_and_palettes():
    levels = RNG.integers(0, 4, (3, 6), dtype=np.uint8)
    packed = np.packbits(np.unpackbits(levels[..., None], axis=2)[..., 6:].reshape(3, -1), axis=1)
    grey = png_file(np.insert(packed, 0, 0, axis=1), 6, 3, 2, 0)
    palette = struct.pack(">I", 12) + b"PLTE" + bytes(range(12)) + b"    "
    coloured = png_file(np.insert(packed, 0, 0, axis=1), 6, 3, 2, 3, palette)
    wide = RNG.integers(0, 65536, (2, 4)).astype(">u2")
    deep = png_file(np.insert(wide.view(np.uint8), 0, 0, axis=1), 4, 2, 16, 0)
    found = png.decoded([grey, coloured, deep])
    assert np.array_equal(found[0][..., 0], levels * 85)
    assert np.array_equal(found[1], np.arange(12, dtype=np.uint8).reshape(4, 3)[levels][..., ::-1])
    assert np.abs(found[2][..., 0].astype(float) - wide / 257).max() <= 0.5
    with pytest.raises(ValueError, match="interlaced"):
        png.decoded([png_file(np.zeros((2, 3), np.uint8), 2, 2, 8, 0, interlaced=1)])


@pytest.mark.parametrize("cut_off", [9, 30, 45, 60])
def test_cut_off_files_do_not_decode(cut_off):
    whole = png_file(np.zeros((40, 41), np.uint8), 40, 40, 8, 0)
    assert png.decoded([whole[:cut_off]]) == [None]
    odd = np.full((4, 5), 9, np.uint8)
    assert png.decoded([png_file(odd, 4, 4, 8, 0)]) == [None]


def test_names_of_stores():
    for root, base in (("/a b/c", "/a b/c"), ("file:/x y", "/x y"), ("file:///x%20y", "/x%20y")):
        system, path = files.opened(root)
        assert system.type_name == "local" and path == base


@pytest.fixture(scope="module")
def made(tmp_path_factory):
    root = tmp_path_factory.mktemp("by manifest") / "set one"
    tiles = {}
    for folder in ("a b", "c%20d", "plain"):
        for i in range(9):
            tiles[f"{folder}/t{i} +.png"] = RNG.integers(0, 256, (4 + i % 2, 5, 3), dtype=np.uint8)
    for name, tile in tiles.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        height, width, _ = tile.shape
        (root / name).write_bytes(png_file(np.insert(tile.reshape(height, -1), 0, 0, axis=1), width, height, 8, 2))
    (root / "a b/junk.png").write_bytes(b"junk")
    (root / "a b/notes.txt").write_text("no image")
    (root / "a b/_hidden.png").write_bytes(b"")
    (root / "a b/deep").mkdir()
    (root / "a b/deep/er.png").write_bytes(b"")
    (root / "top.png").write_bytes(b"junk")
    return str(root), tiles


def by_name(rows):
    return {"/".join(r.filepath.rsplit("/", 2)[-2:]): r for r in rows.collect()}


def test_same_tiles_as_the_reader_of_folders(spark, made, tmp_path):
    root, tiles = made
    place = f"{tmp_path}/manifest"
    manifest.write_manifest(manifest.names_in(spark, root, True), place, range_names=5)
    assert len(manifest.manifest_ranges(place)) >= 6
    for fraction in (1.0, 0.5):
        found = by_name(manifest.read_manifest(spark, place, root, True, fraction=fraction))
        wanted = by_name(images.read_labelled_tiles(spark, root, fraction))
        assert set(found) == set(wanted)
        for name, row in found.items():
            assert row.label == wanted[name].label
            assert row.image.asDict() | {"origin": ""} == wanted[name].image.asDict() | {"origin": ""}
    every = manifest.read_manifest(spark, place, root, True, invalid=True).where("image.height < 0").collect()
    assert [r.filepath.rsplit("/", 1)[1] for r in every] == ["junk.png"]


def test_files_of_any_type_and_some_classes(spark, made, tmp_path):
    root, tiles = made
    place = f"{tmp_path}/manifest"
    manifest.write_manifest(manifest.names_in(spark, root, True, pattern="*"), place)
    files_ = manifest.read_manifest(spark, place, root, True, content=False)
    assert files_.columns == ["filepath", "label"]
    assert set(by_name(files_)) == set(tiles) | {"a b/junk.png", "a b/notes.txt"}
    some = {r.name for r in manifest.names_in(spark, root, True, classes="[ac]*").collect()}
    assert some == {n for n in tiles if n[0] in "ac"} | {"a b/junk.png"}


def test_names_of_an_index_and_flat_tiles(spark, made, tmp_path):
    root, tiles = made
    place = f"{tmp_path}/manifest"
    index = spark.createDataFrame([(f"x/y/t{i} +.png",) for i in range(9)] * 2 + [(None,)], "filename string")
    manifest.write_manifest(manifest.names_of(index, "filename", False), place, range_names=2)
    found = manifest.read_manifest(spark, place, root + "/plain", False).collect()
    assert sorted(r.filepath for r in found) == [f"t{i} +.png" for i in range(9)]
    with pytest.raises(PySparkException, match="FileNotFound|No such file|Failed to open"):
        manifest.read_manifest(spark, place, root, False).collect()


def test_ten_million_names_are_planned_without_reading_them(spark, tmp_path):
    place = f"{tmp_path}/manifest"
    names = spark.range(10_000_000).select(F.format_string("tile_%09d.png", "id").alias("name"))
    names.write.option("parquet.block.row.count.limit", manifest.RANGE_NAMES).parquet(place)
    rows = manifest.read_manifest(spark, place, "/nowhere", False, content=False)
    assert rows.rdd.getNumPartitions() >= 10_000_000 / manifest.RANGE_NAMES
    some = manifest.read_manifest(spark, place, "/nowhere", False, content=False, first=3, last=5)
    assert some.count() == 2 * manifest.RANGE_NAMES


def test_empty_manifest(spark, tmp_path):
    place = f"{tmp_path}/manifest"
    manifest.write_manifest(spark.createDataFrame([], "name string"), place)
    assert manifest.read_manifest(spark, place, "/nowhere", True).count() == 0


# ---- packing


def stored(spark, table):
    return sorted("/".join(r.filepath.rsplit("/", 2)[-2:]) for r in images.read_packed_tiles(spark, table).collect())


@pytest.fixture
def small_ranges(monkeypatch):
    write = manifest.write_manifest
    monkeypatch.setattr(packing, "write_manifest", lambda names, path: write(names, path, range_names=4))


def test_twice_and_with_overlapping_patterns(spark, made, tmp_path, small_ranges):
    root, tiles = made
    table = f"{tmp_path}/table"
    packing.pack(spark, root, table, ["a*", "[ac]*"], ranges_per_pass=2)
    assert stored(spark, table) == sorted(n for n in tiles if n[0] in "ac")
    for _ in range(2):
        ledger = packing.pack(spark, root, table, ["*"], ranges_per_pass=1)
    assert stored(spark, table) == sorted(tiles)
    counts = ledger.where("pass >= 0").agg(F.sum("n_tiles"), F.sum("n_unreadable")).first()
    assert tuple(counts) == (len(tiles), 1)
    assert ledger.where("pass = -1").agg(F.sum("size")).first()[0] == len(tiles) + 1


def test_a_pass_that_was_killed_is_done_again(spark, made, tmp_path, small_ranges, monkeypatch):
    """Killed after the files of a pass are written and before the ledger has it, then before any file."""
    root, tiles = made
    table = f"{tmp_path}/table"
    calls = []

    def killed(*row):
        if row[3] >= 0:  # a pass
            calls.append(row[3])
            if len(calls) == 3:
                raise KeyboardInterrupt
        enter(*row)

    monkeypatch.setattr(packing, "enter", killed)
    with pytest.raises(KeyboardInterrupt):
        packing.pack(spark, root, table, ["*"], ranges_per_pass=2)
    before = stored(spark, table)
    assert before and len(before) < len(tiles) and len(before) == len(set(before))
    monkeypatch.setattr(packing, "enter", enter)
    # with other pass sizes, and more tiles than before
    packing.pack(spark, root, table, ["*"], ranges_per_pass=3)
    assert stored(spark, table) == sorted(tiles)
    rows = read_ledger(spark, table).where("pass >= 0").collect()
    assert len({(r.manifest, r["pass"]) for r in rows}) == len(rows)


def test_flat_folder_by_names(spark, made, tmp_path, small_ranges):
    root, _ = made
    table = f"{tmp_path}/flat"
    names = spark.createDataFrame([(f"t{i} +.png",) for i in range(4)], "name string")
    packing.pack(spark, root + "/plain", table, None, names)
    assert len(images.read_packed_tiles(spark, table).collect()) == 4
    packing.pack(spark, root + "/plain", table, None)
    found = images.read_packed_tiles(spark, table)
    assert found.columns == ["filepath", "image"] and found.count() == 9


def test_a_table_that_was_never_packed(spark, tmp_path):
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        images.read_packed_tiles(spark, f"{tmp_path}/none").count()
    assert read_ledger(spark, f"{tmp_path}/none").count() == 0
