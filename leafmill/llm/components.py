"""Connected components of an edge table, as joins and aggregations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component of every node of ``edges`` (a, b): the smallest node that edges reach.

    Each round takes the smallest component among a node and its neighbours and then that of the component's own
    node, so paths shorten by doubling. Nothing but the number of changes comes to the driver.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct())
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component"))
    labels = stored(labels)
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        found = labels.join(seen.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        found = stored(found)
        jump = found.select(F.col("node").alias("of"), F.col("component").alias("beyond"))
        found = stored(found.join(jump, found["component"] == jump["of"]).select("node", "old", F.col("beyond").alias("component")))
        labels = found.select("node", "component")
        if found.where("old != component").limit(1).count() == 0:
            return labels
