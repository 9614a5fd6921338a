"""Connected components of a table of links, by smallest labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """links[a, b] -> node, component (the smallest node that it reaches), for the nodes that have links.

    Each round takes the smallest label among a node and its neighbours, then the label's own label,
    so the number of rounds grows with the logarithm of a path. Labels are written every round.
    """
    spark = links.sparkSession
    both = common.stored(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        .distinct(),
        "links",
    )
    labels = common.stored(both.groupBy("node").agg(F.min("other").alias("o")).select("node", F.least("node", "o").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "component"), "other").groupBy("node").agg(F.min("component").alias("near"))
        least = common.stored(labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("component")), "least")
        up = least.select(F.col("node").alias("component"), F.col("component").alias("up"))
        after = common.stored(least.join(up, "component").select("node", "was", F.col("up").alias("component")), "labels")
        changed = after.filter("component != was").limit(1).count()
        common.remove(labels, spark)
        common.remove(least, spark)
        labels = after.select("node", "component")
        if not changed:
            common.remove(both, spark)
            return labels
