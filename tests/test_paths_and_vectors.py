import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landtiles.functions.paths import base_name, class_name, plain_path
from landtiles.functions.vectors import argmax, decimals, hash_fraction, ratio, two_fields


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


PATHS = ["a/b/c.png", "a.png", "/a.png", "a//b.png", "a/b/", "", "s3://x/y z/t+1.png", "/", "a/b//c"]


def test_path_parts_follow_posix_rules(spark):
    assert column(spark, PATHS, "string", base_name) == [os.path.basename(p) for p in PATHS]
    wanted = [os.path.basename(os.path.dirname(p)) for p in PATHS]
    assert column(spark, PATHS, "string", class_name) == wanted


def test_percent_decoding_keeps_plus(spark):
    found = column(spark, ["a%20b/c+d.png", "e%2520f"], "string", plain_path)
    assert found == ["a b/c+d.png", "e%20f"]


def test_argmax_ties_nan_and_empty(spark):
    nan = float("nan")
    values = [[1.0, 3.0, 3.0], [2.0, nan, 5.0], [], None, [-1.0]]
    assert column(spark, values, "array<double>", argmax) == [1, 1, None, None, 0]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.floats(width=32, allow_infinity=True), min_size=1, max_size=9), min_size=1, max_size=30))
def test_argmax_like_numpy(spark, values):
    found = column(spark, values, "array<double>", argmax)
    assert found == [int(np.argmax(v)) for v in values]


def test_ratio_of_nothing_is_null(spark):
    row = spark.range(1).select(
        ratio(F.lit(1), F.lit(0)).alias("a"), ratio(F.lit(1), F.lit(4)).alias("b")
    ).first()
    assert (row.a, row.b) == (None, 0.25)


def test_decimals_round_like_python(spark):
    values = [0.0625, 0.1875, 0.0005, 0.0015, 0.0045, 0.9995, 1.0, 0.0, 1 / 3] + [i / 2000 for i in range(2001)]
    assert column(spark, values, "double", lambda v: decimals(v, 3)) == [f"{v:.3f}" for v in values]


def test_two_fields_is_strict(spark):
    assert column(spark, [" a,b "], "string", lambda v: two_fields(v, ",")) == [["a", "b"]]
    for line in ("a", "a,b,c", "  "):
        with pytest.raises(PySparkException, match="expected two fields"):
            column(spark, [line], "string", lambda v: two_fields(v, ","))


def test_hash_fraction_is_even(spark):
    share = spark.range(20000).where(hash_fraction(F.concat(F.lit("t"), "id")) < 0.3).count()
    assert abs(share / 20000 - 0.3) < 0.02
