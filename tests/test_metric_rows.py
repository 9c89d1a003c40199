import pyarrow as pa
from pyspark import TaskContext

from landtiles.operators import runlog


def test_metrics_are_not_made_by_one_task(spark, tmp_path):
    def tasks(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"v": pa.array([float(TaskContext.get().taskAttemptId())] * batch.num_rows)})

    made = spark.range(8, numPartitions=4).mapInArrow(tasks, "v double")
    runlog.append_metrics(runlog.value_metrics(made, "run", "m", "v"), f"{tmp_path}/metrics")
    found = runlog.read_metrics(spark, f"{tmp_path}/metrics")
    assert found.count() == 8 and found.select("value_double").distinct().count() == 4
    assert len(found.inputFiles()) == 1
