"""The ledger of a table of packed tiles: which manifests it has, and which passes over them are committed."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

LEDGER = "manifest int, pass int, root string, labelled boolean, size bigint, n_tiles bigint, n_unreadable bigint"


def ledger_path(table: str) -> str:
    return f"{table}_ledger"


def manifest_path(table: str, number: int) -> str:
    return f"{table}_manifests/number={number}"


def read_ledger(spark: SparkSession, table: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(ledger_path(table))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def enter(spark: SparkSession, table: str, *row) -> None:
    spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(ledger_path(table))


def committed(spark: SparkSession, table: str) -> DataFrame:
    """The tiles of the passes that the ledger has."""
    done = read_ledger(spark, table).where("pass >= 0").select("manifest", "pass").distinct()
    return spark.read.parquet(table).join(done, ["manifest", "pass"], "left_semi").drop("manifest", "pass")
