import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landtiles.operators import metrics
from landtiles.sources import tables

ROWS = [("a", "a"), ("a", "b"), ("a", "a"), ("b", "c"), ("b", "b"), ("d", "a"), ("d", "z")]


@pytest.fixture(scope="module")
def counts(spark):
    rows = spark.createDataFrame(ROWS, "label string, pred_label string")
    return metrics.confusion_counts(rows)


def brute_force(rows):
    for label in sorted({t for t, _ in rows}):
        tp = sum(t == label == p for t, p in rows)
        fp = sum(t != label and p == label for t, p in rows)
        fn = sum(t == label and p != label for t, p in rows)
        tn = len(rows) - tp - fp - fn
        yield (
            label, tp, tn, fp, fn,
            tp / (tp + fp) if tp + fp else None,
            tp / (tp + fn) if tp + fn else None,
            (tp + tn) / len(rows),
        )


def test_one_vs_rest(counts):
    found = [tuple(r) for r in metrics.one_vs_rest(counts).orderBy("label").collect()]
    assert found == list(brute_force(ROWS))


def test_recall_uses_all_rows_of_the_label(counts):
    found = {r.label: r.recall for r in metrics.one_vs_rest(counts).collect()}
    assert found == {"a": 2 / 3, "b": 1 / 2, "d": 0.0}


def test_overall_accuracy_and_no_rows(spark, counts):
    assert metrics.overall_accuracy(counts).first().asDict() == {
        "n_total": 7, "n_correct": 3, "accuracy": 3 / 7,
    }
    none = spark.createDataFrame([], "label string, pred_label string")
    assert metrics.overall_accuracy(metrics.confusion_counts(none)).first().accuracy is None


def test_matrix_is_limited_to_true_labels(counts):
    found = {(r.label, r.pred_label): r.n for r in metrics.confusion_matrix(counts).collect()}
    assert len(found) == 9
    assert found["a", "a"] == 2 and found["d", "d"] == 0 and ("b", "c") not in found
    assert metrics.outside_predictions(counts).first().n_outside == 2
    wide = metrics.confusion_wide(counts).orderBy("label")
    assert wide.columns == ["label", "a", "b", "d"]
    assert [tuple(r) for r in wide.collect()] == [("a", 2, 1, 0), ("b", 0, 1, 0), ("d", 1, 0, 0)]


@pytest.mark.parametrize("width", [1, 2, 3, 1024])
def test_matrix_in_blocks_of_columns(counts, width):
    labels = ["a", "b", "d"]
    dense = {(r.label, r.pred_label): r.n for r in metrics.confusion_matrix(counts, width).collect()}
    cells = {(r.label, r.pred_label): r.n for r in metrics.confusion_cells(counts).collect()}
    assert cells == {k: n for k, n in dense.items() if n}
    found = {}
    for r in metrics.confusion_blocks(counts, width).collect():
        assert r.cells and all(c.at < width for c in r.cells)
        found |= {(r.label, labels[r.block * width + c.at]): c.n for c in r.cells}
    assert found == cells


def test_matrix_of_a_million_classes(spark):
    """Five million cells that occur, of 10 ** 12."""
    n = 1_000_000
    name = lambda c: F.format_string("c%07d", c)
    cells = spark.range(n).select("id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k")).select(
        name(F.col("id")).alias("label"), name((F.col("id") * 7 + F.col("k") * 1000) % n).alias("pred_label"), (F.col("k") + 1).cast("bigint").alias("n")
    )
    blocks = metrics.confusion_blocks(cells)
    found = blocks.select("label", "block", F.inline("cells")).agg(
        F.count("*").alias("cells"), F.sum("n").alias("n"), F.max(F.col("block") * 1024 + F.col("at")).alias("last"), F.count_distinct("label").alias("labels")
    ).first()
    assert tuple(found) == (5 * n, 15 * n, n - 1, n)
    with pytest.raises(ValueError, match="confusion_blocks"):
        metrics.confusion_wide(cells)


def test_report_says_undefined(counts):
    found = {r.label: r for r in metrics.class_report(metrics.one_vs_rest(counts)).collect()}
    assert found["d"].precision.startswith("Undefined")
    assert found["a"].recall == "0.667"


def test_one_label_with_most_rows(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aaaaaab"), rng.choice("aab")) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "label string, pred_label string").repartition(8)
    found = metrics.one_vs_rest(metrics.confusion_counts(frame)).orderBy("label").collect()
    assert [tuple(r) for r in found] == list(brute_force(rows))


def test_predictions_are_read_once(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, "label string, pred_label string")
    rows.write.parquet(f"{tmp_path}/p")
    stored = spark.read.parquet(f"{tmp_path}/p")
    plan = metrics.one_vs_rest(metrics.confusion_counts(stored))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text or text.count("FileScan") == 1


def test_missing_labels_end_the_job(spark, tmp_path):
    (tmp_path / "p.csv").write_text("filepath,label,pred_label\nx,a,\n")
    with pytest.raises(PySparkException, match="missing pred_label"):
        tables.read_test_predictions(spark, f"{tmp_path}/p.csv").collect()


def test_class_names_stay_text_and_columns_go_by_name(spark, tmp_path):
    (tmp_path / "p.csv").write_text('extra,pred_label,label,filename\n1,NA,1,"a ""q"", b/x.png"\n')
    row = tables.read_test_predictions(spark, f"{tmp_path}/p.csv", "filename").first()
    assert tuple(row) == ('a "q", b/x.png', "1", "NA")
