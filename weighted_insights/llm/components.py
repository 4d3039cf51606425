"""Connected components of a link table, as repeated joins and minimums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import settle


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` for every id that occurs in a link; ``component`` is the smallest id reachable.

    Every round each id takes the smallest label among its neighbours, and then the label of that label, so paths shorten
    geometrically.  Rounds are written to the shared folder; nothing but the count of changed labels reaches the driver.
    Null ids and links of an id to itself are left out.
    """
    there = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = settle(there.union(there.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels = settle(both.groupBy("x").agg(F.min("y").alias("low")).select(F.col("x").alias("id"), F.least("x", "low").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("near"))
        hopped = labels.join(near.withColumnRenamed("x", "id"), "id").select("id", "label", F.least("label", "near").alias("hop"))
        jump = labels.select(F.col("id").alias("hop"), F.col("label").alias("jump"))
        moved = hopped.join(jump, "hop").select("id", F.least("hop", "jump").alias("label"), (F.col("label") != F.least("hop", "jump")).alias("changed"))
        moved = settle(moved, "labels")
        if not moved.where("changed").limit(1).count():
            return moved.select("id", F.col("label").alias("component"))
        labels = moved.select("id", "label")
