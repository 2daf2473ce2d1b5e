"""Connected components of a link table, without leaving the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of (a, b) links: the smallest node that can be reached.

    Rounds of "take the smallest label of your neighbours, then the label of your label"; chains shorten by more than half
    in a round. Every round is written, so a lost executor repeats at most one. The links are a written table: they are
    counted first.
    """
    rows = 2 * links.count()
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(gathered(both, rows), "links")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component"))
    labels = written(gathered(least, rows), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("m")), "b").groupBy("a").agg(F.min("m").alias("m"))
        new = labels.join(near, F.col("node") == F.col("a")).select("node", "component", F.least("component", "m").alias("next"))
        parent = labels.select(F.col("node").alias("next"), F.col("component").alias("up"))
        new = new.join(parent, "next").select("node", "component", F.least("next", "up").alias("next"))
        new = written(gathered(new, rows), "labels")
        moved = not new.filter(F.col("next") != F.col("component")).isEmpty()
        labels = new.select("node", F.col("next").alias("component"))
        if not moved:
            return labels
