"""Running sums over an ordering of any length, without a one-task window.

A window with ``orderBy`` and no partition sends every row to one task.  Here the
order column is cut into value ranges first: sums run inside each range in
parallel, and each range starts from the total of the ranges before it.  The
result is exact.  The range table has at most ``buckets`` rows per key; Spark
broadcasts it if it is small enough.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = "_range"
#: Ranges whose cuts are literals of the plan, whatever the size of the cluster.
BUCKETS = 256
SKETCHES = 64


def range_cuts(rows: DataFrame, column: str, buckets: int | None = None) -> list[float]:
    """At most ``buckets - 1`` cut points that split ``column`` into even ranges.

    Coarse sketches are enough: the cuts decide how even the ranges are, never the result.  The first level has
    one sketch per ``SKETCHES``-th part of the tasks, so no task merges the sketches of all others.
    """
    buckets = buckets or BUCKETS
    first = F.array([F.lit(i / (2 * buckets)) for i in range(2 * buckets + 1)])
    steps = F.array([F.lit(i / buckets) for i in range(1, buckets)])
    part = F.pmod(F.spark_partition_id(), F.lit(SKETCHES))
    parts = rows.groupBy(part.alias("part")).agg(F.percentile_approx(column, first, F.lit(4 * buckets)).alias("cuts"))
    sketch = parts.select(F.explode("cuts").alias("cut")).agg(F.percentile_approx("cut", steps, F.lit(4 * buckets)).alias("cuts"))
    return sorted(set(sketch.first()["cuts"] or []))


def with_range(rows: DataFrame, column: str, cuts: Sequence[float]) -> DataFrame:
    """Add the range number; equal values always share a range."""
    if not cuts:
        return rows.withColumn(RANGE, F.lit(0))
    bounds = [float("-inf"), *cuts, float("inf")]
    cut = Bucketizer(splits=bounds, inputCol=column, outputCol=RANGE, handleInvalid="error")
    return cut.transform(rows).withColumn(RANGE, F.col(RANGE).cast("int"))


def running_sums(
    points: DataFrame,
    order: str,
    sums: Sequence[str],
    cuts: Sequence[float],
    keys: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add running and neighbour columns to one-row-per-value ``points``.

    For each summed column ``s``: ``cum_s`` (sum up to and including this point),
    ``total_s`` (sum over all points of the key) and ``next_s`` (value at the
    following point, NULL at the end).  ``next_<order>`` is the following order value
    and ``is_first`` marks the first point of the key.
    """
    keys = list(keys)
    ranged = with_range(points, order, cuts)

    def along(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    first_value = F.max if descending else F.min
    first_row = F.max_by if descending else F.min_by
    ranges = ranged.groupBy(*keys, RANGE).agg(
        *[F.sum(s).alias(f"_sum_{s}") for s in sums],
        first_value(order).alias("_first"),
        *[first_row(s, order).alias(f"_first_{s}") for s in sums],
    )
    across = Window.partitionBy(*keys).orderBy(along(RANGE))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    match = [*keys, RANGE]
    offsets = ranges.select(
        *[F.col(c).alias(f"_of_{c}") for c in match],
        *[F.coalesce(F.sum(f"_sum_{s}").over(before), F.lit(0.0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(whole).alias(f"total_{s}") for s in sums],
        (F.row_number().over(across) == 1).alias("_first_range"),
        F.lead("_first").over(across).alias("_after"),
        *[F.lead(f"_first_{s}").over(across).alias(f"_after_{s}") for s in sums],
    )
    inside = Window.partitionBy(*keys, RANGE).orderBy(along(order))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per range and key.  A null-safe match adds no null filter to one side only, so that
    # both sides share one aggregation.
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in match])
    joined = ranged.join(offsets, same)
    kept = [c for c in points.columns if c not in keys]
    return joined.select(
        *keys,
        *kept,
        *[(F.col(f"_before_{s}") + F.sum(s).over(upto)).alias(f"cum_{s}") for s in sums],
        *[F.col(f"total_{s}") for s in sums],
        (F.col("_first_range") & (F.row_number().over(inside) == 1)).alias("is_first"),
        F.coalesce(F.lead(order).over(inside), F.col("_after")).alias(f"next_{order}"),
        *[F.coalesce(F.lead(s).over(inside), F.col(f"_after_{s}")).alias(f"next_{s}") for s in sums],
    )
