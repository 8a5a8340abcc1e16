"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import written


def connected(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node, label for every node of ``links`` (a long, b long); the label is the component's smallest node.

    Each round a node takes the smallest label among its neighbours' and then its label's own
    label (pointer jumping), so the rounds grow with the logarithm of a component's diameter.
    Every round is written to the shared folder; only a count of changes reaches the driver.
    """
    edges = written(spark, links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "cc-edges")
    labels = written(spark, edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                     .select("node", F.least("node", "near").alias("label")), "cc-labels")
    while True:
        seen = (edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        pulled = labels.join(seen, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        to = pulled.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = written(spark, pulled.join(to, "label").select("node", "was", F.col("next").alias("label")), "cc-labels")
        if jumped.filter("was <> label").limit(1).count() == 0:
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
