"""Connected components of a link table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.llm.staging import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the undirected links; ``root`` is the smallest node reachable.

    Each round gives every node the smallest of its label, its neighbours' labels and its label's
    label, so the number of rounds grows with the logarithm of the longest path rather than its
    length.  A round is one job of joins and partially aggregated minima, and one written table.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(
        links.select(F.col(b).alias("node"), F.col(a).alias("other"))).filter("node <> other").distinct()
    both = staged(both, "links")
    labels = staged(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root")), "labels")
    while True:
        known = labels.select("node", "root")
        near = both.join(known.select(F.col("node").alias("other"), F.col("root").alias("seen")), "other") \
            .groupBy("node").agg(F.min("seen").alias("seen"))
        up = known.select(F.col("node").alias("root"), F.col("root").alias("top"))
        labels = staged(known.join(near, "node").join(up, "root").select(
            "node", F.col("root").alias("was"), F.least("root", "seen", "top").alias("root")), "labels")
        if labels.filter(F.col("was") != F.col("root")).isEmpty():
            return labels.select("node", "root")
