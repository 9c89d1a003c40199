"""Predictions placed on the ground: join to tile bounds, grid, pixels, map."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landtiles.fixed import BLACK, PALETTE
from landtiles.operators.labels import ordinals
from landtiles.session import cut
from landtiles.sources.tables import CORNERS

# Width of one piece of a raster line. It bounds the pixels gathered into one row.
LINE_BLOCK = 4096
# Side of the square blocks of the sparse map; it bounds the runs of one row.
BLOCK_SIDE = 256


def locate(predictions: DataFrame, tiles: DataFrame) -> DataFrame:
    """``name, pred_label`` and corners of the tiles found in both inputs.

    Names that occur several times multiply. Should one name hold a large part of
    either input, adaptive execution splits its join partition by map output.
    """
    return predictions.join(tiles, "name", "inner").select("name", "pred_label", *CORNERS)


def join_report(predictions: DataFrame, tiles: DataFrame) -> DataFrame:
    """One row on how well the names of the two inputs match.

    Names are counted on each side before they meet, so a frequent name is one row.
    """
    left = predictions.groupBy("name").agg(F.count("*").alias("n_pred"))
    right = tiles.groupBy("name").agg(F.count("*").alias("n_tile"))
    both = left.join(right, "name", "full_outer")
    no_tile, no_pred = F.col("n_tile").isNull(), F.col("n_pred").isNull()

    def total(value: Column, name: str) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).alias(name)

    return both.agg(
        total(F.when(no_tile, F.col("n_pred")), "n_unmatched_predictions"),
        total(F.when(no_pred, F.col("n_tile")), "n_unmatched_tiles"),
        F.count_if(F.col("n_pred") > 1).alias("n_repeated_predictions"),
        F.count_if(F.col("n_tile") > 1).alias("n_repeated_tiles"),
        total(F.col("n_pred") * F.col("n_tile"), "n_located"),
    )


def first_rows(located: DataFrame, count: int = 5) -> DataFrame:
    """The first rows by name, then label and corners."""
    return located.orderBy("name", "pred_label", *CORNERS).limit(count)


def grid_index(located: DataFrame) -> DataFrame:
    """Add ``x_idx`` and ``y_idx``: rank of the longitude and latitude of the lower-left corner."""
    located = cut(located, "located")
    return _on_grid(located)


def pixel_table(located: DataFrame, on_unknown: str = "error") -> DataFrame:
    """``row_idx, col_idx, name, pred_label, r, g, b``, one row per pixel that has a tile.

    Row 0 is the northernmost. Of several tiles on one pixel the greatest name wins, then
    the greatest label. A class without a colour ends the job, or is black on request.
    """
    if on_unknown not in ("error", "black"):
        raise ValueError('on_unknown must be "error" or "black"')
    label = F.col("pred_label")
    if on_unknown == "error":
        unknown = F.raise_error(F.concat(F.lit("no colour for class "), label))
        label = F.when(label.isin(*PALETTE), label).otherwise(unknown)
    tops = located.groupBy("llcrnrlat", "llcrnrlon").agg(
        F.max(F.struct("name", label.alias("pred_label"))).alias("top")
    )
    tops = cut(tops.select("llcrnrlat", "llcrnrlon", "top.name", "top.pred_label"), "pixels")
    grid = _on_grid(tops)
    return grid.select(
        (F.col("max_y_idx") - F.col("y_idx")).alias("row_idx"),
        F.col("x_idx").alias("col_idx"),
        "name",
        "pred_label",
        *(_channel(i).alias(c) for i, c in enumerate("rgb")),
    )


def z_order(row_block: Column, col_block: Column) -> Column:
    """One number for a block of the map, its two numbers' bits in turn, so that neighbours are near each other."""

    def spread(value: Column) -> Column:
        value = value.cast("bigint")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                            (2, 0x3333333333333333), (1, 0x5555555555555555)):
            value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
        return value

    return F.shiftleft(spread(row_block), 1).bitwiseOR(spread(col_block))


def raster_size(pixels: DataFrame) -> DataFrame:
    """One row ``height, width``: lines and columns of the whole map."""

    def count(column: str) -> Column:
        return (F.coalesce(F.max(column), F.lit(-1)) + 1).cast("bigint")

    return pixels.agg(count("row_idx").alias("height"), count("col_idx").alias("width"))


def raster_runs(pixels: DataFrame, side: int = BLOCK_SIDE) -> DataFrame:
    """``z, row_idx, runs``: what is painted of each line in each block of ``side`` x ``side`` pixels.

    ``runs`` is an array of ``col_idx, n, r, g, b`` from left to right: ``n`` pixels of one colour from a column on.
    Blocks and lines without a tile have no row, so the size of the result follows the tiles and not the map. Rows
    come in Z-order of the blocks: a window of the map lies in few stored files.
    """
    line, colour = ["z", "row_idx"], ["r", "g", "b"]
    z = z_order(F.floor(F.col("row_idx") / side), F.floor(F.col("col_idx") / side))
    placed = pixels.select(z.alias("z"), "row_idx", "col_idx", *colour).repartition(*line)
    # a run's pixels have one distance between column and rank among the line's pixels of that colour
    rank = F.row_number().over(Window.partitionBy(*line, *colour).orderBy("col_idx"))
    runs = placed.withColumn("run", F.col("col_idx") - rank).groupBy(*line, *colour, "run").agg(
        F.min("col_idx").alias("col_idx"), F.count("*").alias("n")
    )
    lines = runs.groupBy(*line).agg(F.array_sort(F.collect_list(F.struct("col_idx", "n", *colour))).alias("runs"))
    return lines.orderBy("z", "row_idx")


def pixels_of(runs: DataFrame) -> DataFrame:
    """``row_idx, col_idx, r, g, b`` of the pixels in ``runs``."""
    each = runs.select("row_idx", F.inline("runs"))
    columns = F.sequence(F.col("col_idx"), F.col("col_idx") + F.col("n") - 1)
    return each.select("row_idx", F.explode(columns).alias("col_idx"), "r", "g", "b")


def runs_in_window(runs: DataFrame, rows: tuple[int, int], cols: tuple[int, int], side: int = BLOCK_SIDE) -> DataFrame:
    """The stored lines of the blocks that a window of rows and columns, ends included, touches.

    All these blocks lie between the Z-order numbers of the window's corners, which storage is searched by.
    """
    low, high = (z_order(F.lit(r // side), F.lit(c // side)) for r, c in zip(rows, cols))
    near = runs.where(F.col("z").between(low, high) & F.col("row_idx").between(*rows))
    touches = F.exists("runs", lambda x: (x["col_idx"] <= cols[1]) & (x["col_idx"] + x["n"] > cols[0]))
    return near.where(touches)


def raster_lines(runs: DataFrame, size: DataFrame, block: int = LINE_BLOCK) -> DataFrame:
    """``row_idx, block_idx, pixels``: the whole map on request, black where no tile lies.

    ``pixels`` is an array of ``r, g, b`` from left to right. A line wider than ``block`` spans several rows,
    numbered by ``block_idx``. The result is as large as the map, whatever was painted.
    """
    whole = size.first()
    painted = (
        pixels_of(runs).withColumn("block_idx", F.floor(F.col("col_idx") / block))
        .withColumn("at", (F.col("col_idx") - F.col("block_idx") * block).cast("int"))
        .groupBy("row_idx", "block_idx")
        .agg(F.array_sort(F.collect_list(F.struct("at", "r", "g", "b"))).alias("painted"))
    )
    blocks = F.sequence(*(F.lit(i).cast("bigint") for i in (0, max(0, whole.width - 1) // block)))
    frame = runs.sparkSession.range(whole.height).select(
        F.col("id").alias("row_idx"), F.explode(blocks).alias("block_idx")
    )
    left = F.lit(whole.width) - F.col("block_idx") * block
    lines = frame.withColumn("width", F.least(F.lit(block), left).cast("int"))
    return lines.join(painted, ["row_idx", "block_idx"], "left").select(
        "row_idx", "block_idx", _filled(F.col("painted"), F.col("width")).alias("pixels")
    )


def _filled(painted: Column, width: Column) -> Column:
    """Array of ``width`` colours: sorted painted pixels with black in all gaps."""
    black = F.struct(*(F.lit(v).alias(c) for v, c in zip(BLACK, "rgb")))

    def gap(after: Column, before: Column) -> Column:
        return F.array_repeat(black, before - after - 1)

    def with_gap(pixel: Column, i: Column) -> Column:
        previous = F.coalesce(F.get(painted, i - 1)["at"], F.lit(-1))
        colour = F.struct(*(pixel[c].alias(c) for c in "rgb"))
        return F.concat(gap(previous, pixel["at"]), F.array(colour))

    last = F.element_at(painted, -1)["at"]
    filled = F.concat(F.flatten(F.transform(painted, with_gap)), gap(last, width))
    return F.coalesce(filled, F.array_repeat(black, width))


def _on_grid(rows: DataFrame) -> DataFrame:
    lats = ordinals(rows, "llcrnrlat", "y_idx")
    lons = ordinals(rows, "llcrnrlon", "x_idx")
    return (
        rows.join(lats, "llcrnrlat")
        .join(lons, "llcrnrlon")
        .withColumn("max_y_idx", F.lit(lats.count() - 1).cast("bigint"))
    )


def _channel(i: int) -> Column:
    label = F.col("pred_label")
    value = F.lit(BLACK[i])
    for name, colour in PALETTE.items():
        value = F.when(label == name, F.lit(colour[i])).otherwise(value)
    return value
