"""What the jobs ask of a Spark session: settings, a shared scratch folder, shipped code."""

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits a join partition that one hot name has blown up and picks a
# broadcast only from measured sizes. The Arrow batch bound keeps a batch of 224 x 224
# tiles near 40 MB; the lower open cost packs several hundred small tiles into a task.
JOB_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.files.openCostInBytes": str(256 * 1024),
}


def job_session(name: str) -> SparkSession:
    spark = SparkSession.builder.appName(name).getOrCreate()
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def tile_job(job: Callable) -> Callable:
    """A job on small files: while it runs a task gets several hundred, whatever session it is called with."""
    cost = "spark.sql.files.openCostInBytes"

    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        before = spark.conf.get(cost)
        spark.conf.set(cost, JOB_SETTINGS[cost])
        try:
            return job(spark, *args, **kwargs)
        finally:
            spark.conf.set(cost, before)

    return run


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a local session, once.

    On a cluster the package comes with ``spark-submit --py-files``.
    """
    sc = spark.sparkContext
    package = os.path.dirname(os.path.abspath(__file__))
    from_archive = not os.path.isdir(package)
    if getattr(sc, "_landtiles_shipped", False) or from_archive or not sc.master.startswith("local"):
        return
    stage = tempfile.mkdtemp(prefix="landtiles-code-")
    archive = shutil.make_archive(
        os.path.join(stage, "landtiles"), "zip", os.path.dirname(package), "landtiles"
    )
    sc.addPyFile(archive)
    sc._landtiles_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="landtiles-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/landtiles/{purpose}-{uuid.uuid4().hex}"


def cut(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later steps neither recompute it nor depend on executors that held it, and the
    optimizer knows its true size, so it broadcasts the table only when it is small.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
