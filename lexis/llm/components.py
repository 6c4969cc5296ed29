"""Connected components of a table of links, without gathering any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import Stored


def components(links: DataFrame, stored: Stored) -> DataFrame:
    """``v, c`` for each vertex in ``links`` (columns a, b): c is the smallest
    vertex that v reaches.

    Each round takes the smallest label among a vertex and its neighbours, then
    the label of that label, so long chains shorten quickly; it ends when no
    label changes.  Labels are combined on the map side before they shuffle;
    joins are plain joins of stored tables (a hub's rows can be split)."""
    both = stored.put(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    lab = stored.put(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("c")).withColumnRenamed("a", "v"))
    while True:
        near = both.join(lab, F.col("b") == F.col("v")).groupBy("a").agg(F.min("c").alias("m"))
        step = stored.put(lab.join(near, F.col("v") == F.col("a")).select("v", "c", F.least("c", "m").alias("d")))
        to = step.select(F.col("v").alias("w"), F.col("d").alias("e"))
        nxt = stored.put(step.join(to, F.col("d") == F.col("w")).select("v", "c", F.col("e").alias("n")))
        if nxt.where("n <> c").limit(1).count() == 0:
            return lab
        lab = nxt.select("v", F.col("n").alias("c"))
