"""Connected components by star contraction (Kiveris et al., "Connected Components in MapReduce and Beyond")."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import stored


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, label) for every node that has a link; the label is the smallest node of its component.

    Each round hangs the larger neighbours of every node to the smallest one, then the smaller ones; neighbours are reduced to
    a minimum before they are shuffled, and the join that hands it out can be split by adaptive execution. Rounds go through
    stored tables, so lost executors cost no lineage. No link gives no rows; null ends are not links.
    """
    links = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        larger = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = larger.groupBy("u").agg(F.min("v").alias("low"))
        hung = larger.join(low, "u")
        after = hung.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(low.select("u", F.col("low").alias("v"))).filter("u != v").distinct()
        after = stored(after, "links")
        # both hold distinct links, so they are equal if they have as many and no new one
        done = after.join(links, ["u", "v"], "left_anti").isEmpty() and after.count() == links.count()
        links = after
        if done:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
