import re

import pytest
from pyspark.errors import PySparkException

from landtiles.fixed import CARD_FIELDS
from landtiles.operators import runlog
from landtiles.plans.log_report import log_report
from landtiles.sinks import tables as sinks
from landtiles.sources import tables

LINES = [
    "Finished Epoch[2 of 3]: [Training] loss = 1.5 * 40, metric = 25.00% * 40 2.000s ( 20.0 samples/s);",
    "Finished Epoch[1 of 3]: [Training] loss = 2.5 * 40, metric = 50.00% * 40 4.000s (10.0 samples/s);",
    "Finished Epoch[10 of 3]: [Training] loss = 9.0 * 40, metric = 5.00% * 40 4.000s (10.0 samples/s); tail",
    "Finished Epoch[2 of 3]: [Training] loss = 0.5 * 40, metric = 35.00% * 40 6.000s (40.0 samples/s);",
    " Finished Epoch[1 of 3]: [Training] loss = 7.5 * 40, metric = 50.00% * 40 4.000s (10.0 samples/s);",
    "Finished Epoch[1 of 3]: [Training] loss = x * 40, metric = 50.00% * 40 4.000s (10.0 samples/s);",
    "Finished Epoch[1 of 3]: [Training] loss = 2.5 * 40, metric = 50.00% * 40 4.000s (  10.0 samples/s);",
    "Overall accuracy on test set: 0.912",
    "x Overall accuracy on test set: 0.1",
    "",
]


@pytest.fixture(scope="module")
def log(tmp_path_factory):
    path = tmp_path_factory.mktemp("log") / "stdout.txt"
    path.write_text("\n".join(LINES))
    return str(path)


def test_both_spellings_and_only_whole_lines(spark, log):
    found = [tuple(r) for r in runlog.epoch_lines(tables.read_lines(spark, log)).collect()]
    assert sorted(found) == [
        (1.0, 2.5, 50.0, 4.0, 10.0), (2.0, 0.5, 35.0, 6.0, 40.0),
        (2.0, 1.5, 25.0, 2.0, 20.0), (10.0, 9.0, 5.0, 4.0, 10.0),
    ]


def test_series_follow_epoch_numbers(spark, log):
    means = runlog.epoch_means(runlog.epoch_lines(tables.read_lines(spark, log)))
    found = {r.metric: r.series for r in runlog.epoch_series(means).collect()}
    assert found == {
        "training_loss": [2.5, 1.0, 9.0], "training_error_pct": [50.0, 30.0, 5.0],
        "epoch_duration": [4.0, 4.0, 4.0], "samples_per_sec": [10.0, 30.0, 10.0],
    }


def test_number_that_is_none_ends_the_job(spark):
    line = LINES[0].replace("1.5", "1.5.2")
    rows = spark.createDataFrame([(line,)], "value string")
    with pytest.raises(PySparkException, match="missing loss"):
        runlog.epoch_lines(rows).first()


def test_report_job_appends(spark, log, tmp_path):
    metrics = f"{tmp_path}/metrics"
    first = log_report(spark, log, metrics, "one")
    assert first.count() == 5
    log_report(spark, log, metrics, "two")
    found = runlog.read_metrics(spark, metrics)
    assert found.count() == 10 and found.where("ts is null").count() == 0
    row = first.where("metric = 'test_set_accuracy'").first()
    assert row.value_double == 0.912


def test_scalar_metrics(spark):
    rows = runlog.scalar_metrics(spark, "r", {"frac": 0.5, "name": "m", "n": 3}).collect()
    assert {(r.metric, r.value_double, r.value_string) for r in rows} == {
        ("frac", 0.5, None), ("name", None, "m"), ("n", 3.0, None),
    }


CARD = dict(zip(CARD_FIELDS, ["m1", "classifier", "resnet18", "last_only", "randomforest"]))


def test_card_file(spark, tmp_path):
    path = f"{tmp_path}/m1/model.info"
    sinks.write_card(spark, path, CARD)
    text = "".join(p.read_text() for p in sorted((tmp_path / "m1/model.info").glob("part-*")))
    assert re.findall("(.*),(.*)", text) == list(CARD.items())
    lines = tables.read_cards(spark, path).select("value")
    row = tables.card_rows(tables.card_fields(lines, []), [], CARD_FIELDS).first()
    assert row.asDict() == CARD


def card(spark, lines):
    frame = spark.createDataFrame([("m", line) for line in lines], "model string, value string")
    fields = tables.card_fields(frame, ["model"])
    return tables.card_rows(fields, ["model"], ("model_source", "retraining_type")).collect()


def test_card_lines(spark):
    (row,) = card(spark, ["", " model_source,dnn ", "other,x", ""])
    assert (row.model_source, row.retraining_type) == ("dnn", None)
    with pytest.raises(PySparkException, match="expected two fields"):
        card(spark, ["model_source,dnn,more"])
    with pytest.raises(PySparkException, match="two values for model_source"):
        card(spark, ["model_source,dnn", "model_source,classifier"])
