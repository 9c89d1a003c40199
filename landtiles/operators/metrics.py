"""Quality of predictions.

Everything follows from the counts per (label, pred_label) pair, so the predictions are
read once and their shuffle carries at most one row per pair and task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landtiles.functions.vectors import ratio, three_decimals
from landtiles.operators.labels import label_index
from landtiles.session import cut

COLUMN_BLOCK = 1024  # columns of the confusion matrix in one row
MOST_COLUMNS = 1000  # of the wide form


def confusion_counts(predictions: DataFrame) -> DataFrame:
    """``label, pred_label, n`` for the pairs that occur."""
    return predictions.groupBy("label", "pred_label").agg(F.count("*").alias("n"))


def stored_counts(predictions: DataFrame) -> DataFrame:
    """The same counts, stored, for use in several reports.

    On counts that are not stored the optimizer may move parts of a report below the
    grouping and read the predictions again.
    """
    return cut(confusion_counts(predictions), "counts")


def overall_accuracy(counts: DataFrame) -> DataFrame:
    """One row: ``n_total, n_correct, accuracy``."""
    right = F.when(F.col("label") == F.col("pred_label"), F.col("n")).otherwise(0)
    sums = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_total"),
        F.coalesce(F.sum(right), F.lit(0)).alias("n_correct"),
    )
    return sums.withColumn("accuracy", ratio(F.col("n_correct"), F.col("n_total")))


def one_vs_rest(counts: DataFrame) -> DataFrame:
    """Per true label: the four outcome counts, precision, recall and accuracy.

    Each pair counts once for its true label and once for its predicted label, which
    gives row and column sums in one grouping. Precision and recall are NULL where
    nothing was predicted or labelled so.
    """
    n = F.col("n")
    sides = F.array(
        F.struct(
            F.col("label").alias("label"),
            n.alias("labelled"),
            F.lit(0).cast("bigint").alias("predicted"),
            F.when(F.col("label") == F.col("pred_label"), n).otherwise(0).alias("hit"),
        ),
        F.struct(
            F.col("pred_label").alias("label"),
            F.lit(0).cast("bigint").alias("labelled"),
            n.alias("predicted"),
            F.lit(0).cast("bigint").alias("hit"),
        ),
    )
    sums = (
        counts.select(F.inline(sides))
        .groupBy("label")
        .agg(*(F.sum(c).alias(c) for c in ("labelled", "predicted", "hit")))
        .where("labelled > 0")
    )
    total = counts.agg(F.sum("n").alias("n_total")).scalar()
    outcomes = sums.withColumn("n_total", total).select(
        "label",
        F.col("hit").alias("n_true_pos"),
        (F.col("n_total") - F.col("labelled") - F.col("predicted") + F.col("hit")).alias("n_true_neg"),
        (F.col("predicted") - F.col("hit")).alias("n_false_pos"),
        (F.col("labelled") - F.col("hit")).alias("n_false_neg"),
        "n_total",
    )
    tp, tn = F.col("n_true_pos"), F.col("n_true_neg")
    return outcomes.select(
        "label",
        "n_true_pos",
        "n_true_neg",
        "n_false_pos",
        "n_false_neg",
        ratio(tp, tp + F.col("n_false_pos")).alias("precision"),
        ratio(tp, tp + F.col("n_false_neg")).alias("recall"),
        ratio(tp + tn, F.col("n_total")).alias("accuracy"),
    )


def class_report(per_class: DataFrame) -> DataFrame:
    """Per-class ratios as text with three decimals, for people."""
    return per_class.select(
        "label",
        three_decimals(
            F.col("recall"), "Undefined (class absent from the test set)"
        ).alias("recall"),
        three_decimals(
            F.col("precision"), "Undefined (class never predicted)"
        ).alias("precision"),
        three_decimals(F.col("accuracy")).alias("accuracy"),
    )


def confusion_cells(counts: DataFrame) -> DataFrame:
    """``label, pred_label, n`` of the pairs of true labels that occur: the matrix without its zeros.

    Predictions outside the true labels have no column; ``outside_predictions`` counts them. Hand in stored counts:
    they are used several times.
    """
    return counts.join(_true_labels(counts).withColumnRenamed("label", "pred_label"), "pred_label", "left_semi")


def confusion_blocks(counts: DataFrame, width: int = COLUMN_BLOCK) -> DataFrame:
    """``label, block, cells``: each line of the matrix in blocks of ``width`` columns, blocks of zeros left out.

    Columns are the true labels in sorted order, numbered by a range-partitioned sort. ``cells`` is a sorted array of
    ``at, n``: the column's place in the block and its count.
    """
    index = cut(label_index(_true_labels(counts)), "label-index")
    column = index.select(F.col("label").alias("pred_label"), "idx")
    placed = confusion_cells(counts).join(column, "pred_label").select(
        "label", F.floor(F.col("idx") / width).alias("block"), (F.col("idx") % width).cast("int").alias("at"), "n"
    )
    return placed.groupBy("label", "block").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("cells"))


def confusion_matrix(counts: DataFrame, width: int = COLUMN_BLOCK) -> DataFrame:
    """``label, pred_label, n`` for every pair of true labels, zero where none occurs: the square of the labels."""
    index = cut(label_index(_true_labels(counts)), "label-index")
    total = index.count()
    blocks = F.sequence(*(F.lit(i).cast("bigint") for i in (0, max(0, total - 1) // width)))
    frame = index.select("label", F.explode(blocks).alias("block"))
    lines = frame.join(confusion_blocks(counts, width), ["label", "block"], "left")
    size = F.least(F.lit(width), F.lit(total) - F.col("block") * width).cast("int")
    cells = F.coalesce("cells", F.array().cast("array<struct<at:int,n:bigint>>"))
    line = lines.select("label", "block", _filled(cells, size).alias("line"))
    cells = line.select("label", "block", F.posexplode("line").alias("at", "n"))
    named = index.select(F.col("label").alias("pred_label"), "idx")
    return cells.withColumn("idx", F.col("block") * width + F.col("at")).join(named, "idx").select("label", "pred_label", "n")


def confusion_wide(counts: DataFrame) -> DataFrame:
    """One row per true label and one column per true label, in sorted order.

    Column names are a part of the plan, so this form is for people and ends with an error beyond ``MOST_COLUMNS``
    labels; ``confusion_cells`` and ``confusion_blocks`` hold for any number.
    """
    labels = [row.label for row in _true_labels(counts).orderBy("label").limit(MOST_COLUMNS + 1).collect()]
    if len(labels) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} labels make no readable table; take confusion_blocks")
    wide = counts.groupBy("label").pivot("pred_label", labels).agg(F.sum("n"))
    return wide.select("label", *(F.coalesce(wide[_quoted(c)], F.lit(0)).alias(c) for c in labels))


def _filled(cells: Column, size: Column) -> Column:
    """Array of ``size`` counts: those of the cells, zeros between them."""
    zero = F.lit(0).cast("bigint")

    def with_gap(cell: Column, i: Column) -> Column:
        before = F.coalesce(F.get(cells, i - 1)["at"], F.lit(-1))
        return F.concat(F.array_repeat(zero, cell["at"] - before - 1), F.array(cell["n"]))

    last = F.coalesce(F.get(cells, F.size(cells) - 1)["at"], F.lit(-1))
    return F.concat(F.flatten(F.transform(cells, with_gap)), F.array_repeat(zero, size - last - 1))


def _true_labels(counts: DataFrame) -> DataFrame:
    return counts.select("label").distinct()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def outside_predictions(counts: DataFrame) -> DataFrame:
    """One row: ``n_outside``, how many predictions name a class that is no true label."""
    labels = counts.select(F.col("label").alias("pred_label")).distinct()
    outside = counts.join(labels, "pred_label", "left_anti")
    return outside.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_outside"))
