"""Connected components of a table of links, in Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node label`` for every node of ``links`` (a, b: long); the label is the smallest node.

    Every round takes the smallest label next door and then the label of that label, so the
    rounds grow with the logarithm of a component's width. Each round is a written table.
    """
    links = stored(
        links.selectExpr("a AS node", "b AS other").union(links.selectExpr("b", "a")).distinct(),
        "links",
    )
    labels = stored(
        links.groupBy("node").agg(F.min("other").alias("label")).selectExpr(
            "node", "least(node, label) AS label"
        ),
        "labels",
    )
    while True:
        near = links.join(labels.withColumnRenamed("node", "other"), "other")
        reached = near.select("node", "label").union(labels)
        hooked = reached.groupBy("node").agg(F.min("label").alias("label"))
        jumped = hooked.alias("x").join(
            labels.selectExpr("node AS label", "label AS next"), "label"
        )
        after = stored(
            jumped.select("node", F.least("label", "next").alias("label")), "labels"
        )
        # Labels only become smaller, so they are final when their sum is.
        total = F.sum(F.col("label").cast("decimal(38,0)"))
        if labels.agg(total).first() == after.agg(total).first():
            return after
        labels = after
