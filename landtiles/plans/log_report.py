"""Job: turn a training log into recorded metrics."""

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession

from landtiles.operators.runlog import (
    append_metrics,
    epoch_lines,
    epoch_means,
    epoch_series,
    log_accuracy,
    read_metrics,
    series_metrics,
    value_metrics,
)
from landtiles.session import job_session
from landtiles.sources.tables import read_lines


def log_report(spark: SparkSession, log: str, metrics: str, run_id: str | None = None) -> DataFrame:
    """Appends four series and the test accuracy; returns the metrics of this run."""
    run_id = run_id or uuid.uuid4().hex
    lines = read_lines(spark, log)
    series = series_metrics(epoch_series(epoch_means(epoch_lines(lines))), run_id)
    accuracy = value_metrics(log_accuracy(lines), run_id, "test_set_accuracy", "accuracy")
    append_metrics(series.unionByName(accuracy), metrics)
    found = read_metrics(spark, metrics)
    return found.where(found.run_id == run_id)


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--log", required=True, help="text of a training run")
    parser.add_argument("--metrics", required=True, help="folder of recorded metrics")
    parser.add_argument("--run-id")
    args = parser.parse_args(argv)
    for row in log_report(job_session("log report"), args.log, args.metrics, args.run_id).toLocalIterator():
        print(*row, sep="\t")


if __name__ == "__main__":
    main()
