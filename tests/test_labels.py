import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landtiles.operators import labels
from landtiles.sinks import tables as sinks
from landtiles.sources import tables


def test_ordinals_alike_in_one_task_and_spread(spark):
    values = spark.range(5000).select((F.col("id") * 7919 % 1234 / 4.0).alias("v"))
    one = labels.ordinals(values, "v", "i").collect()
    spread = labels.ordinals(values.repartition(40), "v", "i").collect()
    wanted = {v: i for i, v in enumerate(sorted({k * 7919 % 1234 / 4.0 for k in range(5000)}))}
    assert dict(one) == dict(spread) == wanted


def test_text_is_sorted_by_code_point(spark):
    rows = spark.createDataFrame([("b",), ("B",), ("é",), ("10",), ("9",), ("B",)], "label string")
    assert dict(labels.label_index(rows).collect()) == {"10": 0, "9": 1, "B": 2, "b": 3, "é": 4}


def test_positions_with_equal_keys_number_every_row(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("k"), "id")
    found = labels.positions(rows, ["k", "id"], "p").orderBy("p").collect()
    assert [r.p for r in found] == list(range(3000))
    assert [(r.k, r.id) for r in found] == sorted((i % 3, i) for i in range(3000))


def test_unknown_label_and_index_end_the_job(spark):
    index = spark.createDataFrame([("a", 0)], "label string, idx bigint")
    rows = spark.createDataFrame([("b", [0.0, 1.0])], "label string, s array<double>")
    with pytest.raises(PySparkException, match="missing"):
        labels.add_index(rows, index).collect()
    with pytest.raises(PySparkException, match="missing"):
        labels.predict_label(rows, "s", index).collect()


def test_shuffle_repeats_and_depends_on_seed(spark):
    rows = spark.range(200).select(F.concat(F.lit("f"), "id").alias("filename"))
    names = lambda seed: [r.filename for r in labels.shuffled(rows, seed).collect()]
    assert names("1") == names("1") != names("2")
    assert sorted(names("1")) == sorted(names("2"))


def test_map_file_keeps_its_order_on_disk(spark, tmp_path):
    files = spark.range(400).select(
        F.concat(F.lit("d/"), F.col("id") % 3, F.lit("/t"), "id").alias("filename"),
        (F.col("id") % 3).cast("string").alias("label"),
    )
    rows = labels.map_rows(files, labels.label_index(files)).cache()
    sinks.write_map_file(rows, f"{tmp_path}/map")
    lines = [
        line.split("\t")[0]
        for part in sorted(tmp_path.glob("map/part-*"))
        for line in part.read_text().splitlines()
    ]
    assert lines == [r.filename for r in rows.orderBy("shuffle_key", "filename").collect()]
    assert tables.read_map_file(spark, f"{tmp_path}/map").count() == 400


def test_label_index_file_has_no_header_and_one_part(spark, tmp_path):
    rows = spark.createDataFrame([('quo"te',), ("a b",), ("NA",)], "label string")
    sinks.write_label_index(labels.label_index(rows), f"{tmp_path}/index")
    (part,) = tmp_path.glob("index/part-*")
    assert part.read_text() == 'NA\t0\na b\t1\nquo"te\t2\n'
    found = tables.read_label_index(spark, f"{tmp_path}/index").collect()
    assert {(r.label, r.idx) for r in found} == {("NA", 0), ("a b", 1), ('quo"te', 2)}


def test_class_and_size(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "label string")
    assert labels.class_and_size(rows).first().asDict() == {"num_classes": 2, "epoch_size": 3}


def test_files_of_another_header_end_the_job(spark, tmp_path):
    from landtiles.sources.tables import read_test_predictions

    (tmp_path / "a.csv").write_text("filepath,label,pred_label\nx.png,Forest,Forest\n")
    (tmp_path / "b.csv").write_text("pred_label,label,filepath\nShrub,Forest,y.png\n")
    with pytest.raises(Exception):
        read_test_predictions(spark, str(tmp_path)).collect()


def test_a_tile_without_a_corner_ends_the_job(spark, tmp_path):
    from landtiles.sources.tables import read_tile_index

    head = "filename,llcrnrlat,llcrnrlon,urcrnrlat,urcrnrlon\n"
    (tmp_path / "t.csv").write_text(head + "a.png,1,2,3,4\nb.png,1,,3,4\n")
    with pytest.raises(Exception, match="llcrnrlon"):
        read_tile_index(spark, str(tmp_path)).collect()


def test_a_root_is_no_pattern(spark, tmp_path):
    from landtiles.sources.images import list_class_files

    (tmp_path / "train" / "Forest").mkdir(parents=True)
    (tmp_path / "train" / "Forest" / "a.png").write_bytes(b"x")
    with pytest.raises(ValueError):
        list_class_files(spark, f"{tmp_path}/tr*")
    for root in (f"{tmp_path}/train", f"file:{tmp_path}/train", f"file://{tmp_path}/train/"):
        assert list_class_files(spark, root).count() == 1


def test_a_log_field_that_is_no_number_ends_the_job(spark):
    from landtiles.operators.runlog import epoch_lines

    line = "Finished Epoch[1 of 4]: [Training] loss = 1.2.3 * 100, metric = 4.5% * 100 1.25s (40.75 samples/s);"
    with pytest.raises(Exception, match="loss"):
        epoch_lines(spark.createDataFrame([(line,)], "value string")).collect()
