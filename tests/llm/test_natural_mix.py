"""Models of a sample below the row count keep the mix of the marks over all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landtiles.llm import rules, toxicity
from landtiles.llm.common import natural_weights
from llm.conftest import prose, table


@pytest.fixture(scope="module")
def rare(spark):
    """Marks that no text tells: one in ten is toxic, one in ten is bad."""
    rows = [(i, prose(i, 60)) for i in range(1500)]
    marks = [(i, int(i % 10 != 3), int(i % 10 == 3)) for i in range(1500)]
    return table(spark, rows), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")


def mean_score(found):
    return found.agg(F.avg("score")).first()[0]


def test_toxicity_of_a_small_sample(rare):
    docs, labels = rare
    assert abs(mean_score(toxicity.toxicity(docs, toxicity.fit_toxicity(docs, labels, 60))) - 0.1) < 0.1


def test_calibration_of_a_small_sample(rare):
    docs, labels = rare
    assert abs(mean_score(rules.apply_rules(docs, rules.fit_rules(docs, labels, 60))) - 0.9) < 0.1


def test_weights_restore_the_mix():
    marks, totals = np.array([0, 1, 1, 0, 0]), np.array([900, 100, 100, 900, 900])
    weight = natural_weights(marks, totals)
    assert np.isclose(weight.mean(), 1) and np.isclose(weight[marks == 1].sum() / weight.sum(), 0.1)
    assert np.allclose(natural_weights(marks, np.array([3, 2, 2, 3, 3])), 1)
