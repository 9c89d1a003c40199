import hashlib
import struct
import zlib

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landtiles.functions import pixels
from landtiles.operators import featurize as fz
from landtiles.operators import models
from landtiles.sources import images
from samples.network import BIAS, WEIGHTS, network_bytes, network_file


def png(tile: np.ndarray) -> bytes:
    """RGB or grey image as PNG."""
    height, width = tile.shape[:2]
    kind = 2 if tile.ndim == 3 else 0
    lines = np.concatenate([np.zeros((height, 1), np.uint8), tile.reshape(height, -1)], axis=1)

    def chunk(name, data):
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0))
        + chunk(b"IDAT", zlib.compress(lines.tobytes()))
        + chunk(b"IEND", b"")
    )


@pytest.fixture(scope="module")
def made(tmp_path_factory):
    root = tmp_path_factory.mktemp("tiles") / "set one"
    rng = np.random.default_rng(1)
    tiles = {
        "a b/solid.png": np.full((8, 8, 3), (10, 20, 30), np.uint8),
        "a b/two words+plus.png": rng.integers(0, 256, (8, 8, 3), dtype=np.uint8),
        "c%20d/wide.png": rng.integers(0, 256, (20, 30, 3), dtype=np.uint8),
        "c%20d/small.png": rng.integers(0, 256, (2, 3, 3), dtype=np.uint8),
        "grey/grey.png": rng.integers(0, 256, (8, 8), dtype=np.uint8),
    }
    for name, tile in tiles.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(png(tile))
    (root / "a b/junk.png").write_bytes(b"junk")
    (root / "a b/notes.txt").write_text("no image")
    (root / "top.png").write_bytes(png(tiles["a b/solid.png"]))
    (root / "a b/deep").mkdir()
    (root / "a b/deep/er.png").write_bytes(png(tiles["a b/solid.png"]))
    return str(root), tiles


def found_by_name(rows):
    return {"/".join(r.filepath.rsplit("/", 2)[1:]): r for r in rows.collect()}


def rgb(tile):
    return np.repeat(tile[..., None], 3, axis=2) if tile.ndim == 2 else tile


def test_labelled_tiles(spark, made):
    root, tiles = made
    rows = found_by_name(images.read_labelled_tiles(spark, root))
    assert set(rows) == set(tiles)
    for name, row in rows.items():
        assert row.label == name.split("/")[0]
        stored = np.frombuffer(bytes(row.image.data), np.uint8)
        shape = (row.image.height, row.image.width, row.image.nChannels)
        bgr = stored.reshape(shape)[..., ::-1]
        assert np.array_equal(rgb(tiles[name])[..., : shape[2]], bgr)


def test_tiles_are_decoded_as_the_image_reader_does(spark, tmp_path):
    rng = np.random.default_rng(2)
    rgb_file = png(rng.integers(0, 256, (4, 5, 3), dtype=np.uint8))
    dot = struct.pack(">IIBBBBB", 1, 1, 8, 2, 0, 0, 1)
    interlaced = rgb_file[:8] + struct.pack(">I", 13) + b"IHDR" + dot + struct.pack(">I", zlib.crc32(b"IHDR" + dot))
    body = zlib.compress(b"\0abc")
    interlaced += struct.pack(">I", len(body)) + b"IDAT" + body + struct.pack(">I", zlib.crc32(b"IDAT" + body)) + rgb_file[-12:]
    bitmap = b"BM" + struct.pack("<IHHI", 58, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + b"\1\2\3\0"
    plain = {"a.png": rgb_file, "b c.png": png(rng.integers(0, 256, (6, 6), dtype=np.uint8))}
    others = {"dot.png": interlaced, "map.png": bitmap, "junk.png": b"junk", "none.png": b"", "head.png": rgb_file[:8]}
    for folder, files in {"plain": plain, "mixed": plain | others}.items():
        (tmp_path / folder).mkdir()
        for name, content in files.items():
            (tmp_path / folder / name).write_bytes(content)
    for folder in ("plain", "mixed"):
        found = images.read_flat_tiles(spark, f"{tmp_path}/{folder}")
        wanted = spark.read.format("image").option("dropInvalid", True).load(f"{tmp_path}/{folder}").select("image")
        assert sorted(r.image for r in found.collect()) == sorted(r.image for r in wanted.collect())
        assert found.count() == (2 if folder == "plain" else 4)
    bad = images.unreadable_tiles(spark, f"{tmp_path}/mixed", labelled=False).collect()
    assert {r.filepath.rsplit("/", 1)[1] for r in bad} == {"junk.png", "head.png"}  # an empty file gives no row
    plan = images.read_flat_tiles(spark, f"{tmp_path}/plain")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan image" not in plan  # its encoder for every file


def test_other_spellings_of_the_root(spark, made):
    root, tiles = made
    for spelling in (root + "/", "file://" + root):
        assert images.read_labelled_tiles(spark, spelling).count() == len(tiles)


def test_flat_tiles_are_only_those_in_the_folder(spark, made):
    root, _ = made
    assert [r.filepath for r in images.read_flat_tiles(spark, root).collect()] == ["top.png"]
    flat = images.read_flat_tiles(spark, root + "/a b").select("filepath").collect()
    assert {r.filepath for r in flat} == {"solid.png", "two words+plus.png"}


def test_unreadable_and_missing(spark, made):
    root, _ = made
    found = images.unreadable_tiles(spark, root, labelled=True).collect()
    assert [r.filepath.rsplit("/", 1)[1] for r in found] == ["junk.png"]
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        images.read_labelled_tiles(spark, root + "/none")


def test_listing_takes_any_type_one_level_down(spark, made):
    root, tiles = made
    files = images.list_class_files(spark, root)
    names = {"/".join(r.filename.rsplit("/", 2)[1:]) for r in files.collect()}
    assert names == set(tiles) | {"a b/junk.png", "a b/notes.txt"}
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_sampling_is_repeatable_and_leaves_files_unopened(spark, made):
    root, tiles = made
    wanted = {
        n for n in tiles
        if int(hashlib.md5(n.encode()).hexdigest()[:8], 16) / 2**32 < 0.6
    }
    sample = images.read_labelled_tiles(spark, root, fraction=0.6)
    assert set(found_by_name(sample)) == wanted
    scan = sample._jdf.queryExecution().executedPlan().collectLeaves().head()
    sample._jdf.queryExecution().toRdd().count()
    assert scan.metrics().get("numFiles").get().value() <= len(wanted) + 1  # and the junk file
    for fraction in (0.0, 1.5, -1.0):
        with pytest.raises(ValueError):
            images.read_labelled_tiles(spark, root, fraction)


def plain_resize(tile, side):
    """Pixel by pixel linear interpolation."""
    height, width = tile.shape[:2]
    out = np.empty((side, side, 3))
    for i in range(side):
        for j in range(side):
            y = min(max((i + 0.5) * height / side - 0.5, 0), height - 1)
            x = min(max((j + 0.5) * width / side - 0.5, 0), width - 1)
            y0, x0 = int(y), int(x)
            y1, x1 = min(y0 + 1, height - 1), min(x0 + 1, width - 1)
            fy, fx = y - y0, x - x0
            out[i, j] = (
                tile[y0, x0] * (1 - fy) * (1 - fx) + tile[y1, x0] * fy * (1 - fx)
                + tile[y0, x1] * (1 - fy) * fx + tile[y1, x1] * fy * fx
            )
    return out


def test_block_features_by_brute_force(spark, made):
    root, tiles = made
    side = 16
    rows = found_by_name(fz.featurize(images.read_labelled_tiles(spark, root), side=side))
    assert set(rows) == set(tiles)
    for name, row in rows.items():
        scaled = plain_resize(rgb(tiles[name]).astype(float), side)[..., ::-1]
        means = [
            scaled[2 * i : 2 * i + 2, 2 * j : 2 * j + 2, c].mean() - 114
            for c in range(3) for i in range(8) for j in range(8)
        ]
        assert np.allclose(row.features[:192], means, atol=1e-3)
        shares = np.array(row.features[192:]).reshape(3, 8)
        assert np.allclose(shares.sum(axis=1), 1)


def test_default_side_and_mean_only_of_solid_tile(spark, made):
    root, _ = made
    rows = found_by_name(fz.featurize(images.read_labelled_tiles(spark, root)))
    features = rows["a b/solid.png"].features
    assert features[:192] == [30 - 114] * 64 + [20 - 114] * 64 + [10 - 114] * 64


def test_unroll_is_channel_height_width():
    tile = np.arange(2 * 3 * 3).reshape(1, 2, 3, 3)
    assert pixels.unroll(tile).ravel().tolist() == [
        tile[0, y, x, c] for c in range(3) for y in range(2) for x in range(3)
    ]


@pytest.mark.parametrize("batch", ["n", 3])
def test_network_layers(spark, made, batch):
    root, tiles = made
    path = network_file(spark, f"net{batch}.onnx", 8, batch)
    tile_rows = images.read_labelled_tiles(spark, root)
    inner = found_by_name(fz.featurize(tile_rows, fz.OnnxNetwork(spark, path, "z.x"), 8))
    outer = found_by_name(fz.featurize(tile_rows, fz.OnnxNetwork(spark, path), 8))
    for name, tile in tiles.items():
        means = plain_resize(rgb(tile).astype(float), 8)[..., ::-1].mean(axis=(0, 1)) - 114
        assert np.allclose(inner[name].features, means, atol=1e-3)
        assert np.allclose(outer[name].features, means @ WEIGHTS + BIAS, atol=1e-2)


def test_two_networks_with_one_file_name(spark, made, tmp_path):
    root, _ = made
    paths = []
    for i, weights in enumerate((WEIGHTS, WEIGHTS * 2)):
        (tmp_path / str(i)).mkdir()
        path = tmp_path / str(i) / "same.onnx"
        path.write_bytes(network_bytes(8, weights=weights))
        paths.append(str(path))
    tile_rows = images.read_labelled_tiles(spark, root)
    one, two = (found_by_name(fz.featurize(tile_rows, fz.OnnxNetwork(spark, p), 8)) for p in paths)
    for name in one:
        assert np.allclose((np.array(one[name].features) - BIAS) * 2, np.array(two[name].features) - BIAS, atol=1e-2)


def test_network_scores_to_labels(spark, made):
    root, _ = made
    index = spark.createDataFrame([(f"k{i}", i) for i in range(6)], "label string, idx bigint")
    network = fz.OnnxNetwork(spark, network_file(spark, "labels.onnx", 8), "scores")
    scores = fz.featurize(images.read_labelled_tiles(spark, root).drop("label"), network, 8)
    wanted = {r.filepath: f"k{int(np.argmax(r.features))}" for r in scores.collect()}
    found = models.apply_network(scores, index)
    assert found.columns == ["filepath", "pred_label"]
    assert dict(found.collect()) == wanted


def test_augmentation_repeats_and_changes_by_epoch(spark, made):
    root, _ = made
    tiles = images.read_labelled_tiles(spark, root)
    runs = [
        {r.filepath: bytes(r.image.data) for r in fz.augment(tiles.repartition(n), F.lit(e), side=32).collect()}
        for n, e in ((1, 1), (4, 1), (2, 2))
    ]
    assert runs[0] == runs[1] and runs[0] != runs[2]
    row = fz.augment(tiles, F.lit(1)).first()
    assert (row.image.height, row.image.width, len(row.image.data)) == (224, 224, 224 * 224 * 3)


def test_crop_and_jitter_by_brute_force():
    rng = np.random.default_rng(5)
    tiles = rng.integers(0, 256, (6, 20, 30, 3)).astype(np.float32)
    draws = rng.random((6, 5))
    cropped = pixels.crop(tiles, draws[:, :2])
    for i in range(6):
        top, left = int(draws[i, 0] * 4), int(draws[i, 1] * 14)
        assert np.array_equal(cropped[i], tiles[i, top : top + 17, left : left + 17])
    unrolled = pixels.unroll(tiles)
    neutral = pixels.jitter(unrolled, np.full((6, 3), 0.5))
    assert np.allclose(neutral, unrolled, atol=1e-2)
    brighter = pixels.jitter(np.full((1, 3, 4, 4), 100, np.float32), np.array([[1.0, 0.5, 0.5]]))
    assert np.allclose(brighter, 120, atol=1e-3)
    grey = pixels.jitter(unrolled, np.array([[0.5, 0.5, 0.0]] * 6))
    assert grey.std(axis=1).mean() < unrolled.std(axis=1).mean()


def test_augmented_tiles_feed_featurize_alike(spark, made):
    root, _ = made
    tiles = images.read_labelled_tiles(spark, root)
    apart = fz.featurize(fz.augment(tiles, F.lit(4), side=16), side=16)
    fused = fz.featurize(tiles, side=16, epoch=F.lit(4))
    one, other = found_by_name(apart), found_by_name(fused)
    for name in one:  # the image in between holds whole numbers
        assert np.allclose(one[name].features[:192], other[name].features[:192], atol=0.51)
