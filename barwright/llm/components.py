"""Connected components of a table of links, without gathering any component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.plans.durable import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and label, the least node of its component, of every node that has a link.

    Every node takes the least label among its neighbours and then the label of its label, until none
    changes; the number of passes grows with the logarithm of the longest chain. Labels are
    numbers; each pass is written, so a lost executor costs no more than the pass at hand.
    """
    both = cut(links.select(F.col(a).alias("node"), F.col(b).alias("to"))
               .union(links.select(F.col(b), F.col(a))).where("node <> to").distinct(), "links")
    labels = cut(both.groupBy("node").agg(F.least(F.col("node"), F.min("to")).alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("to"), F.col("label").alias("other")), "to")
                .groupBy("node").agg(F.min("other").alias("other")))
        step = labels.join(near, "node").select("node", F.col("label").alias("before"),
                                                F.least("label", "other").alias("step"))
        jump = labels.select(F.col("node").alias("step"), F.col("label").alias("far"))
        # a label that is the least of its component has itself as label
        labels = cut(step.join(jump, "step", "left").select(
            "node", "before", F.least("step", F.coalesce("far", "step")).alias("label")), "labels")
        if labels.where("label <> before").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
