"""Training logs and run metrics."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landtiles.fixed import ACCURACY_LINE, EPOCH_LINE
from landtiles.functions.vectors import required
from landtiles.sinks.tables import evened

EPOCH_FIELDS = ("epoch", "loss", "error_pct", "duration", "rate")
# Name under which each epoch column is recorded.
SERIES = {
    "training_loss": "loss",
    "training_error_pct": "error_pct",
    "epoch_duration": "duration",
    "samples_per_sec": "rate",
}
METRIC_SCHEMA = (
    "run_id string, metric string, value_double double, value_string string, "
    "series array<double>, ts timestamp"
)


def epoch_lines(lines: DataFrame) -> DataFrame:
    """The five numbers of each epoch line as doubles; other lines are left out.

    The cheap prefix test spares most lines the pattern, and one replacement cuts a line
    into all of its fields. A field of digits and dots that is no number ends the job.
    """
    value = F.col("value")
    fields = F.split(F.regexp_replace(value, EPOCH_LINE + ".*$", "$1 $2 $3 $4 $5"), " ")
    return (
        lines.where(value.startswith("Finished Epoch[") & value.rlike(EPOCH_LINE))
        .select(fields.alias("_f"))
        .select(*(required(F.col("_f")[i].try_cast("double"), c).alias(c) for i, c in enumerate(EPOCH_FIELDS)))
    )


def epoch_means(epochs: DataFrame) -> DataFrame:
    """Mean of the numbers per epoch, over the workers that report it."""
    return epochs.groupBy("epoch").agg(*(F.avg(c).alias(c) for c in EPOCH_FIELDS[1:]))


def epoch_series(means: DataFrame) -> DataFrame:
    """``metric, series``: one list per recorded metric, in epoch order.

    The input has one row per epoch.
    """
    by_epoch = F.array_sort(F.collect_list(F.struct("epoch", *SERIES.values())))
    metrics = F.array(
        *(
            F.struct(
                F.lit(metric).alias("metric"),
                F.col("_epochs")[column].alias("series"),
            )
            for metric, column in SERIES.items()
        )
    )
    return means.agg(by_epoch.alias("_epochs")).select(F.inline(metrics))


def log_accuracy(lines: DataFrame) -> DataFrame:
    """``accuracy`` of every test-accuracy line."""
    text = F.regexp_extract("value", ACCURACY_LINE, 1)
    return lines.where(F.col("value").rlike(ACCURACY_LINE)).select(
        required(text.try_cast("double"), "accuracy").alias("accuracy")
    )


def scalar_metrics(spark: SparkSession, run_id: str, values: dict) -> DataFrame:
    """Metric rows for single values: numbers as doubles, all others as text."""
    rows = []
    for metric, value in values.items():
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        rows.append(
            (run_id, metric, float(value) if number else None, None if number else str(value))
        )
    frame = spark.createDataFrame(
        rows, "run_id string, metric string, value_double double, value_string string"
    )
    return _stamped(frame.withColumn("series", F.lit(None).cast("array<double>")))


def value_metrics(rows: DataFrame, run_id: str, metric: str, column: str, text: str | None = None) -> DataFrame:
    """Metric rows for a numeric column, one per row, with the words of column ``text`` if one is named."""
    return _stamped(
        rows.select(
            F.lit(run_id).alias("run_id"),
            F.lit(metric).alias("metric"),
            F.col(column).cast("double").alias("value_double"),
            (F.col(text) if text else F.lit(None)).cast("string").alias("value_string"),
            F.lit(None).cast("array<double>").alias("series"),
        )
    )


def series_metrics(series: DataFrame, run_id: str) -> DataFrame:
    """Metric rows for ``metric, series``."""
    return _stamped(
        series.select(
            F.lit(run_id).alias("run_id"),
            "metric",
            F.lit(None).cast("double").alias("value_double"),
            F.lit(None).cast("string").alias("value_string"),
            "series",
        )
    )


def append_metrics(rows: DataFrame, path: str) -> None:
    """In the folder of their run; few rows give one small file.

    Rows are brought together behind their own tasks, so that a large input is not read by one.
    """
    evened(rows).write.mode("append").partitionBy("run_id").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    columns = [field.split()[0] for field in METRIC_SCHEMA.split(", ")]
    return spark.read.schema(METRIC_SCHEMA).parquet(path).select(*columns)


def _stamped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ts", F.current_timestamp())
