"""Many attributes in one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aggregate_long(
    df: DataFrame,
    attributes: Mapping[str, Column],
    measure: Column,
    out: str,
    keys: Sequence[str] = (),
    inputs: Sequence[str] = (),
    value: str = "category",
    keep_missing: bool = True,
) -> DataFrame:
    """``measure`` per ``(keys, attribute, value)``, in one scan and one shuffle for all attributes.

    Grouping is by the attribute's position, a small integer; names come back on
    the aggregated rows.  (``unpivot`` gives the same rows, but Spark does not
    recognise two equal ones as one, and would scan the table once per use.)
    """
    values = F.array(list(attributes.values())) if attributes else F.array().cast("array<string>")
    long = df.select(*keys, *inputs, F.posexplode(values).alias("_position", value))
    if not keep_missing:
        long = long.where(F.col(value).isNotNull())
    grouped = long.groupBy(*keys, "_position", value).agg(measure.alias(out))
    names = F.array([F.lit(name) for name in attributes]).cast("array<string>")
    return grouped.select(*keys, names[F.col("_position")].alias("attribute"), value, out)
