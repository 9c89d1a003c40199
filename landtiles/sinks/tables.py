"""Writers. Every file set is written by the tasks that hold the rows."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from landtiles.fixed import CARD_FIELDS


@dataclass(frozen=True)
class ModelPaths:
    """Where the files of one named model lie."""

    models: str
    results: str
    name: str

    @property
    def card(self) -> str:
        return f"{self.models}/{self.name}/model.info"

    @property
    def classifier(self) -> str:
        return f"{self.models}/{self.name}/model"

    @property
    def network(self) -> str:
        return f"{self.models}/{self.name}/retrained.onnx"

    @property
    def label_index(self) -> str:
        return f"{self.models}/{self.name}/labels_to_inds.tsv"

    @property
    def test_predictions(self) -> str:
        return f"{self.results}/{self.name}_predictions_test_set.csv"

    @property
    def predictions(self) -> str:
        return f"{self.results}/{self.name}_predictions_o16n.csv"

    @property
    def metrics(self) -> str:
        return f"{self.results}/run_metrics"


def write_test_predictions(rows: DataFrame, path: str) -> None:
    _with_header(evened(rows.select("filepath", "label", "pred_label")), path)


def write_predictions(rows: DataFrame, path: str) -> None:
    _with_header(evened(rows.select("filepath", "pred_label")), path)


def write_tile_index(rows: DataFrame, path: str) -> None:
    _with_header(rows, path)


def write_label_index(index: DataFrame, path: str) -> None:
    """One file in index order; it has one line per class."""
    _tab_separated(index.select("label", "idx").orderBy("idx").coalesce(1), path)


def write_map_file(rows: DataFrame, path: str) -> None:
    """Keeps the order of the rows across the numbered part files."""
    _tab_separated(rows.select("filename", "idx"), path)


def write_card(spark: SparkSession, path: str, values: dict[str, str]) -> None:
    lines = [(f"{field},{values[field]}",) for field in CARD_FIELDS]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite").text(path)


def evened(rows: DataFrame) -> DataFrame:
    """Rows spread over files of useful size.

    Tasks over images hand out very few bytes each; without this every one of them would
    leave a small file behind.
    """
    return rows.hint("rebalance")


def _with_header(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True, escape='"')


def _tab_separated(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, sep="\t", quote="")
