"""Weighted profiles of segments: shares, rates, means, crosstabs, top categories.

All attributes of a profile go through one ``groupBy``, which
pre-aggregates on the map side: what is shuffled is at most one row per task and
(segment, attribute, category), however the rows are spread over segments.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import present, quoted
from ..functions.features import category_or_na, guarded, number_or_zero, share_text
from .longform import aggregate_long


def row_and_column_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; missing values are not counted."""
    counts = df.where(quoted(column).isNotNull()).groupBy(quoted(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), "value")


def positive_rate(df: DataFrame, label: str = "y", keys: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """The unweighted share of positives, rounded."""
    return df.groupBy(*keys).agg(F.round(F.avg(F.col(label).cast("double")), digits).alias("positive_rate"))


def type_counts(df: DataFrame) -> dict[str, int]:
    """Columns per type name, from the schema."""
    counts: dict[str, int] = {}
    for _, kind in df.dtypes:
        counts[kind] = counts.get(kind, 0) + 1
    return counts


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns that ``after`` has and ``before`` has not, sorted."""
    return sorted(set(after.columns) - set(before.columns))


def segment_ids(df: DataFrame, segment: str = "segment") -> DataFrame:
    return df.select(segment).distinct().orderBy(segment)


def weighted_mean(number: Column, weight: Column) -> Column:
    """Mean in which a missing number counts as zero with its full weight."""
    return F.sum(weight * number_or_zero(number)) / guarded(F.sum(weight))


def segment_summary(
    df: DataFrame,
    segment: str = "segment",
    weight: str = "w",
    label: str | None = "y",
    means: Mapping[str, Column] | Sequence[str] = (),
) -> DataFrame:
    """One row per segment: weighted share, weighted positive rate, weighted means; largest share first.

    One pass and one shuffle.  The window that adds up the total sees one row per segment.
    """
    numbers = means if isinstance(means, Mapping) else {c: quoted(c).cast("double") for c in present(df, means)}
    w = F.col(weight)
    rate = F.sum(w * F.col(label).cast("double")) / guarded(F.sum(w)) if label else F.lit(0.0)
    per_segment = df.groupBy(segment).agg(
        F.sum(w).alias("_w"),
        rate.alias("weighted_pos_rate"),
        *[weighted_mean(number, w).alias(f"mean_{name}") for name, number in numbers.items()],
    )
    total = F.sum("_w").over(Window.partitionBy())
    return per_segment.select(
        segment,
        (F.col("_w") / guarded(total)).alias("weighted_share"),
        "weighted_pos_rate",
        *[quoted(f"mean_{name}") for name in numbers],
    ).orderBy(F.col("weighted_share").desc(), segment)


def segment_shares(df: DataFrame, segment: str = "segment", weight: str = "w") -> DataFrame:
    """Weighted share per segment, in segment order."""
    return segment_summary(df, segment, weight, label=None).select(segment, "weighted_share").orderBy(segment)


def numeric_means(
    df: DataFrame, numbers: Mapping[str, Column] | Sequence[str], segment: str = "segment", weight: str = "w"
) -> DataFrame:
    """Long form ``(segment, attribute, weighted_mean)`` for the bar plots."""
    if not isinstance(numbers, Mapping):
        numbers = {c: quoted(c).cast("double") for c in present(df, numbers)}
    if not numbers:
        return df.select(segment, F.lit("").alias("attribute"), F.lit(0.0).alias("weighted_mean")).limit(0)
    w = F.col(weight)
    wide = df.groupBy(segment).agg(*[weighted_mean(number, w).alias(name) for name, number in numbers.items()])
    return wide.unpivot([segment], [quoted(name) for name in numbers], "attribute", "weighted_mean")


def category_cells(
    df: DataFrame, attributes: Sequence[str], segment: str = "segment", weight: str = "w"
) -> DataFrame:
    """Weight per ``(segment, attribute, category)`` for all attributes in one shuffle."""
    texts = {name: category_or_na(quoted(name)) for name in attributes}
    rows = df.withColumn("w", F.col(weight))
    return aggregate_long(rows, texts, F.sum("w"), "w", keys=[segment], inputs=["w"])


def category_weights(df: DataFrame, attribute: str, weight: str = "w") -> DataFrame:
    """Weight per category of one attribute."""
    return df.groupBy(category_or_na(quoted(attribute)).alias("category")).agg(F.sum(weight).alias("w"))


def top_categories(df: DataFrame, attribute: str, top_n: int = 6, weight: str = "w") -> DataFrame:
    """The heaviest categories of one attribute; ties by name."""
    return category_weights(df, attribute, weight).orderBy(F.col("w").desc(), "category").limit(top_n)


def heaviest(cells: DataFrame, n: int, within: Sequence[str]) -> DataFrame:
    """The ``n`` heaviest categories per group, ranked from 1; ties by name.

    Spark cuts each task's rows to ``n`` per group before the shuffle, so a group
    with very many categories does not land in one task.
    """
    order = Window.partitionBy(*within).orderBy(F.col("w").desc(), "category")
    return cells.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def crosstab(
    df: DataFrame, attributes: Sequence[str], top_n: int = 6, segment: str = "segment", weight: str = "w"
) -> DataFrame:
    """Long form ``(segment, attribute, category, share)`` over the heaviest categories of each attribute.

    The share is of the whole segment's weight, so the rows of a segment need not
    add up to one.  Categories a segment lacks appear with share 0.
    """
    cells = category_cells(df, attributes, segment, weight)
    overall = cells.groupBy("attribute", "category").agg(F.sum("w").alias("w"))
    # At most top_n rows per attribute: small whatever the data.
    top = F.broadcast(
        heaviest(overall, top_n, ["attribute"]).groupBy("attribute").agg(F.collect_set("category").alias("_top"))
    )
    # Per (segment, attribute): the whole weight, and the cells that are among the top.
    listed = F.array_contains("_top", F.col("category"))
    rows = (
        cells.join(top, "attribute")
        .groupBy(segment, "attribute")
        .agg(
            F.sum("w").alias("_w"),
            F.first("_top").alias("_top"),
            F.map_from_entries(F.collect_list(F.when(listed, F.struct("category", "w")))).alias("_cells"),
        )
    )
    return rows.select(segment, "attribute", "_w", "_cells", F.explode("_top").alias("category")).select(
        segment,
        "attribute",
        "category",
        (F.coalesce(F.col("_cells")[F.col("category")], F.lit(0.0)) / guarded(F.col("_w"))).alias("share"),
    )


def crosstab_wide(
    df: DataFrame, attribute: str, top_n: int = 6, segment: str = "segment", weight: str = "w"
) -> DataFrame:
    """One row per segment and one column per top category, heaviest first."""
    names = [r["category"] for r in top_categories(df, attribute, top_n, weight).collect()]
    category = category_or_na(quoted(attribute))
    w = F.col(weight)
    columns = [
        (F.coalesce(F.sum(F.when(category == name, w)), F.lit(0.0)) / guarded(F.sum(w))).alias(name) for name in names
    ]
    return df.groupBy(segment).agg(*columns).orderBy(segment)


def top_per_segment(
    df: DataFrame, attributes: Sequence[str], n: int = 3, segment: str = "segment", weight: str = "w"
) -> DataFrame:
    """``(segment, attribute, top)``: the ``n`` heaviest categories with their shares as text."""
    cells = category_cells(df, attributes, segment, weight)
    # A missing segment is a segment, too: matched null-safely.
    whole = cells.groupBy(quoted(segment).alias("_segment"), F.col("attribute").alias("_attribute")).agg(F.sum("w").alias("_w"))
    same = quoted(segment).eqNullSafe(F.col("_segment")) & (F.col("attribute") == F.col("_attribute"))
    ranked = heaviest(cells, n, [segment, "attribute"]).join(whole, same)
    text = share_text(F.col("category"), F.col("w") / guarded(F.col("_w")))
    return ranked.groupBy(segment, "attribute").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", text.alias("text")))), lambda e: e["text"]), ", ").alias("top")
    )
