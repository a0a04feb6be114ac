"""Connected components by smallest labels and pointer jumping, in stored rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm.frames import stored


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b): the smallest node it reaches.

    Each round takes the smallest label among a node and its neighbours, then that label's
    own label. A star needs two rounds, a path as many as the logarithm of its length or
    few more. Rows of a node with many neighbours are reduced before they are shuffled.
    """
    both = stored(
        spark,
        edges.select("a", "b").unionByName(edges.selectExpr("b AS a", "a AS b")).distinct(),
        "edges",
    )
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("comp")
    )
    labels = stored(spark, labels, "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("comp").alias("near"))
        )
        lower = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("comp").alias("far"))
        found = lower.join(jump, "new", "left").select(
            "node", F.least("new", F.coalesce("far", "new")).alias("comp"), F.col("comp").alias("old")
        )
        found = stored(spark, found, "labels")
        changed = found.where("comp <> old").limit(1).count()
        labels = found.select("node", "comp")
        if not changed:
            return labels
