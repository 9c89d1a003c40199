"""Prediction, tile, label, card and log files as DataFrames.

No schema is inferred: a class named ``1`` or ``NA`` stays text. Columns of files with a
header are found by name, so extra columns and another column order do no harm, as long as
all files of a folder have the same header.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landtiles.functions.paths import base_name, class_name, file_path
from landtiles.functions.vectors import required, two_fields

CORNERS = ("llcrnrlat", "llcrnrlon", "urcrnrlat", "urcrnrlon")


def read_test_predictions(spark: SparkSession, path: str, path_column: str = "filepath") -> DataFrame:
    """``filepath, label, pred_label``. The network path names its first column ``filename``."""
    rows = _with_header(spark, path)
    return rows.select(
        F.col(path_column).alias("filepath"),
        required(F.col("label"), "label").alias("label"),
        required(F.col("pred_label"), "pred_label").alias("pred_label"),
    )


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """``name, pred_label``: the file name of a scored tile and its predicted class."""
    return named(_with_header(spark, path), "filepath").select(
        "name", required(F.col("pred_label"), "pred_label").alias("pred_label")
    )


def read_tile_index(spark: SparkSession, path: str) -> DataFrame:
    """``name`` and the four corner coordinates of each tile."""
    rows = named(_with_header(spark, path), "filename")
    return rows.select("name", *(required(F.col(c).try_cast("double"), c).alias(c) for c in CORNERS))


def named(rows: DataFrame, path_column: str) -> DataFrame:
    """Replace a path column by ``name``, the last segment of the path."""
    name = required(base_name(F.col(path_column)), path_column)
    return rows.withColumn("name", name).drop(path_column)


def read_label_index(spark: SparkSession, path: str) -> DataFrame:
    """``label, idx`` from a tab-separated file without header."""
    return _tab_separated(spark, path, "label string, idx bigint")


def read_map_file(spark: SparkSession, path: str) -> DataFrame:
    """``filename, idx`` from a tab-separated file without header."""
    return _tab_separated(spark, path, "filename string, idx bigint")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_cards(spark: SparkSession, pattern: str) -> DataFrame:
    """``model, value``: the lines of model cards, with the name of each card's folder."""
    return spark.read.text(pattern).select(class_name(file_path()).alias("model"), "value")


def card_fields(lines: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """``key, value`` columns next to ``keys``; empty lines are skipped."""
    pair = two_fields(F.col(value), ",")
    return (
        lines.where(F.col(value) != "")
        .select(*keys, pair.alias("_pair"))
        .select(*keys, F.col("_pair")[0].alias("key"), F.col("_pair")[1].alias("value"))
    )


def card_rows(fields: DataFrame, keys: list[str], wanted: tuple[str, ...]) -> DataFrame:
    """One row per card with one column per wanted field, NULL where the card lacks it.

    A card that gives two values for one field ends the job.
    """

    def field(name: str):
        value = F.when(F.col("key") == name, F.col("value"))
        return (
            F.when(F.min(value).eqNullSafe(F.max(value)), F.max(value))
            .otherwise(F.raise_error(F.lit(f"two values for {name}")))
            .alias(name)
        )

    return fields.groupBy(*keys).agg(*(field(name) for name in wanted))


def _with_header(spark: SparkSession, path: str) -> DataFrame:
    # files of one folder whose headers differ end the job instead of mixing up columns
    return spark.read.csv(path, header=True, escape='"', mode="FAILFAST", enforceSchema=False)


def _tab_separated(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", quote="", mode="FAILFAST")
