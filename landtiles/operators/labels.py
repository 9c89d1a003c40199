"""Class labels: index numbers, lookups, dataset size, shuffled file lists."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landtiles.functions.vectors import argmax, required
from landtiles.session import cut

_ROWS_PER_PARTITION_BITS = 33  # layout of monotonically_increasing_id


def ordinals(values: DataFrame, column: str, index: str) -> DataFrame:
    """``column, index``: the sorted distinct values, numbered from 0 without gaps."""
    return positions(values.select(column).distinct(), [column], index)


def positions(rows: DataFrame, order: list[str], index: str) -> DataFrame:
    """Number all rows from 0 in the given order, without bringing them into one task.

    A range-partitioned sort leaves each row's partition and place in it; the start of a
    partition is the sum of the sizes of those before it, one small row per partition.
    """
    placed = cut(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_at", _ROWS_PER_PARTITION_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.col("_at").bitwiseAND(F.lit((1 << _ROWS_PER_PARTITION_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*rows.columns, (F.col("_start") + within).alias(index))
    )


def label_index(labelled: DataFrame) -> DataFrame:
    """``label, idx`` with classes numbered in sorted order."""
    return ordinals(labelled, "label", "idx")


def add_index(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Add ``idx`` to rows with a ``label``; a label outside the index ends the job."""
    joined = rows.join(index, "label", "left")
    return joined.withColumn("idx", required(F.col("idx"), "index of a label"))


def index_to_label(rows: DataFrame, position: Column, index: DataFrame, target: str) -> DataFrame:
    """Add the label of an index number as ``target``; an unknown number ends the job."""
    names = index.select(F.col("idx").alias("_idx"), F.col("label").alias("_label"))
    return (
        rows.withColumn("_idx", position)
        .join(names, "_idx", "left")
        .withColumn(target, required(F.col("_label"), "label of an index"))
        .drop("_idx", "_label")
    )


def predict_label(scores: DataFrame, column: str, index: DataFrame) -> DataFrame:
    """Add ``pred_label``, the class of the largest score."""
    return index_to_label(scores, argmax(F.col(column)), index, "pred_label")


def class_and_size(labelled: DataFrame) -> DataFrame:
    """``num_classes, epoch_size``.

    Counts per class come first, so one frequent class costs no more than a rare one.
    """
    per_class = labelled.groupBy("label").agg(F.count("*").alias("n"))
    return per_class.agg(
        F.count("label").alias("num_classes"), F.coalesce(F.sum("n"), F.lit(0)).alias("epoch_size")
    )


def shuffled(rows: DataFrame, seed: str = "0") -> DataFrame:
    """The rows in an order that looks random and is the same on every run."""
    return rows.withColumn("shuffle_key", shuffle_key(seed)).orderBy("shuffle_key", "filename")


def shuffle_key(seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.col("filename")).cast("binary"))


def map_rows(files: DataFrame, index: DataFrame, seed: str = "0") -> DataFrame:
    """``filename, idx, shuffle_key`` of labelled files, shuffled."""
    return shuffled(add_index(files, index).select("filename", "idx"), seed)
