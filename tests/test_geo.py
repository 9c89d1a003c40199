import re

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landtiles.fixed import PALETTE
from landtiles.operators import geo

BOUNDS = "name string, llcrnrlat double, llcrnrlon double, urcrnrlat double, urcrnrlon double"
LOCATED = "name string, pred_label string, " + BOUNDS.split(", ", 1)[1]
CLASSES = sorted(PALETTE)


def rows_on_grid(n, height, width, seed=0):
    rng = np.random.default_rng(seed)
    lat, lon = rng.integers(0, height, n) * 0.5 - 3, rng.integers(0, width, n) * 0.25 + 7
    label = rng.integers(0, 6, n)
    return [
        (f"t{i % (n - 5)}", CLASSES[label[i]], float(lat[i]), float(lon[i]), float(lat[i]) + 0.5, float(lon[i]) + 0.25)
        for i in range(n)
    ]


def painted(rows):
    lats, lons = sorted({r[2] for r in rows}), sorted({r[3] for r in rows})
    image = np.zeros((len(lats), len(lons), 3), int)
    for row in sorted(rows):
        image[len(lats) - 1 - lats.index(row[2]), lons.index(row[3])] = PALETTE[row[1]]
    return image


@pytest.mark.parametrize("block", [4, 7, 4096])
def test_map_equals_a_painted_array(spark, block):
    rows = rows_on_grid(90, 9, 14)
    located = spark.createDataFrame(rows, LOCATED).repartition(5)
    pixels = geo.pixel_table(located)
    lines = geo.raster_lines(geo.raster_runs(pixels, side=5), geo.raster_size(pixels), block=block).collect()
    wanted = painted(rows)
    found = [[] for _ in wanted]
    for line in sorted(lines, key=lambda r: (r.row_idx, r.block_idx)):
        assert len(line.pixels) <= block
        found[line.row_idx] += [tuple(p) for p in line.pixels]
    assert np.array_equal(np.array(found), wanted)


def test_grid_index_counts_from_the_lower_left_corner(spark):
    rows = rows_on_grid(50, 5, 6, seed=2)
    found = geo.grid_index(spark.createDataFrame(rows, LOCATED)).collect()
    lats, lons = sorted({r[2] for r in rows}), sorted({r[3] for r in rows})
    assert len(found) == len(rows)
    for r in found:
        assert (r.y_idx, r.x_idx) == (lats.index(r.llcrnrlat), lons.index(r.llcrnrlon))
        assert r.max_y_idx == len(lats) - 1


def test_pixel_with_several_tiles_takes_the_greatest_name(spark):
    rows = [("b", "Forest", 0.0, 0.0, 1.0, 1.0), ("c", "Developed", 0.0, 0.0, 1.0, 1.0),
            ("a", "Cultivated", 0.0, 0.0, 1.0, 1.0), ("c", "Cultivated", 0.0, 0.0, 1.0, 1.0)]
    (pixel,) = geo.pixel_table(spark.createDataFrame(rows, LOCATED)).collect()
    assert (pixel.name, pixel.pred_label, pixel.r, pixel.g, pixel.b) == ("c", "Developed", 255, 0, 0)


def test_class_without_colour(spark):
    rows = [("a", "Water", 0.0, 0.0, 1.0, 1.0), ("b", "Forest", 0.0, 0.0, 1.0, 1.0)]
    located = spark.createDataFrame(rows, LOCATED)
    with pytest.raises(PySparkException, match="no colour for class Water"):
        geo.pixel_table(located)
    (pixel,) = geo.pixel_table(located, on_unknown="black").collect()
    assert pixel.pred_label == "Forest"
    black = geo.pixel_table(located.where("name = 'a'"), on_unknown="black").first()
    assert (black.r, black.g, black.b) == (0, 0, 0)
    with pytest.raises(ValueError):
        geo.pixel_table(located, on_unknown="white")


def test_no_located_tiles_give_an_empty_map(spark):
    pixels = geo.pixel_table(spark.createDataFrame([], LOCATED))
    runs, size = geo.raster_runs(pixels), geo.raster_size(pixels)
    assert tuple(size.first()) == (0, 0) and runs.count() == 0 and geo.raster_lines(runs, size).count() == 0


@pytest.mark.parametrize("side", [1, 3, 256])
def test_runs_are_the_painted_pixels_of_their_block(spark, side):
    rows = rows_on_grid(300, 12, 17, seed=4)
    pixels = geo.pixel_table(spark.createDataFrame(rows, LOCATED))
    painted_ = {(p.row_idx, p.col_idx): (p.r, p.g, p.b) for p in pixels.collect()}
    found, order = {}, []
    for line in geo.raster_runs(pixels, side).collect():
        order.append((line.z, line.row_idx))
        ends = None
        for run in line.runs:
            assert run.n >= 1 and line.z == plain_z(line.row_idx // side, run.col_idx // side)
            assert run.col_idx // side == (run.col_idx + run.n - 1) // side
            assert ends is None or run.col_idx > ends[0] or (run.col_idx == ends[0] and (run.r, run.g, run.b) != ends[1])
            ends = run.col_idx + run.n, (run.r, run.g, run.b)
            found |= {(line.row_idx, run.col_idx + k): ends[1] for k in range(run.n)}
    assert found == painted_ and order == sorted(order)


def plain_z(row, col):
    return sum(((row >> i & 1) << 2 * i + 1) | ((col >> i & 1) << 2 * i) for i in range(31))


def test_two_far_tiles_take_two_rows(spark):
    """A map of a million by a million pixels with two tiles on it."""
    pixels = spark.createDataFrame([(0, 0, 1, 2, 3), (999_999, 999_999, 4, 5, 6)], "row_idx bigint, col_idx bigint, r int, g int, b int")
    assert tuple(geo.raster_size(pixels).first()) == (1_000_000, 1_000_000)
    found = geo.raster_runs(pixels).collect()
    assert [(r.z, r.row_idx, [tuple(x) for x in r.runs]) for r in found] == [
        (0, 0, [(0, 1, 1, 2, 3)]), (plain_z(999_999 // 256, 999_999 // 256), 999_999, [(999_999, 1, 4, 5, 6)])
    ]


def test_window_of_the_map_reads_few_blocks(spark, tmp_path):
    pixels = spark.range(200 * 200).select(
        F.floor(F.col("id") / 200).alias("row_idx"), (F.col("id") % 200).alias("col_idx"),
        *(F.lit(i).alias(c) for i, c in enumerate("rgb")),
    )
    path = f"{tmp_path}/runs"
    geo.raster_runs(pixels, 8).write.parquet(path)
    some = geo.runs_in_window(spark.read.parquet(path), (40, 44), (16, 30), 8)
    assert re.search(r"z#\d+L >= \d+", some._jdf.queryExecution().executedPlan().toString())
    found = {(p.row_idx, p.col_idx) for p in geo.pixels_of(some).collect()}
    assert found == {(r, c) for r in range(40, 45) for c in range(16, 32)}


def test_join_multiplies_repeated_names_and_reports_them(spark):
    pred = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("q", "x")], "name string, pred_label string")
    tiles = spark.createDataFrame(
        [(n, 0.0, 0.0, 1.0, 1.0) for n in ("a", "a", "b", "z", "z")], BOUNDS
    )
    assert geo.locate(pred, tiles).count() == 5
    assert geo.join_report(pred, tiles).first().asDict() == {
        "n_unmatched_predictions": 1, "n_unmatched_tiles": 2, "n_repeated_predictions": 1,
        "n_repeated_tiles": 2, "n_located": 5,
    }
    first = geo.first_rows(geo.locate(pred, tiles), 3).collect()
    assert [(r.name, r.pred_label) for r in first] == [("a", "x"), ("a", "x"), ("a", "y")]


def test_name_with_most_rows_is_split(spark, tmp_path):
    """A third of all predictions share a name; its join partition must not be one task."""
    n = 300_000
    name = F.when(F.col("id") % 3 == 0, "hot.png").otherwise(F.concat(F.lit("t"), "id", F.lit(".png")))
    pred = spark.range(0, n, 1, 16).select(name.alias("name"), F.md5(F.col("id").cast("string")).alias("pred_label"))
    pred.write.parquet(f"{tmp_path}/pred")
    tiles = spark.range(n).select(
        F.when(F.col("id") == 0, "hot.png").otherwise(F.concat(F.lit("t"), "id", F.lit(".png"))).alias("name"),
        *(F.rand(i).alias(c) for i, c in enumerate(geo.CORNERS)),
    )
    tiles.write.parquet(f"{tmp_path}/tiles")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        located = geo.locate(spark.read.parquet(f"{tmp_path}/pred"), spark.read.parquet(f"{tmp_path}/tiles"))
        rows = located.groupBy().agg(F.count("*").alias("n"), F.count_if(F.col("name") == "hot.png").alias("hot"),
                                    F.sum(F.length("pred_label")).alias("length"))
        (found,) = rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert (found.n, found.hot, found.length) == (n, n // 3, 32 * n)
    assert "skew=true" in plan
