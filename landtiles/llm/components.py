"""Connected components of a link table, by smallest labels and pointer jumping, never off the executors."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landtiles.session import cut


def components(links: DataFrame) -> DataFrame:
    """``vid, label`` for each end of the links ``a, b``; the label is the smallest vid that can be reached.

    Each round takes the smallest label among neighbours, then the label of the label, so distances to
    the smallest label shrink by half. A vertex with very many links is met with partial aggregation and with
    joins whose crowded partitions can be split.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut(both.where("a != b").distinct(), "links")
    labels = cut(both.groupBy("a").agg(F.min("b").alias("near")).select(
        F.col("a").alias("vid"), F.least("a", "near").alias("label"), F.lit(True).alias("changed")), "labels")
    while not labels.where("changed").isEmpty():
        near = both.join(labels.select(F.col("vid").alias("b"), "label"), "b").groupBy(F.col("a").alias("vid")).agg(
            F.min("label").alias("near")
        )
        lower = labels.join(near, "vid").select("vid", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        heads = labels.select(F.col("vid").alias("label"), F.col("label").alias("head"))
        jumped = lower.join(heads, "label").withColumn("next", F.least("label", "head"))
        labels = cut(jumped.select("vid", F.col("next").alias("label"), (F.col("next") != F.col("old")).alias("changed")), "labels")
    return labels.select("vid", "label")
