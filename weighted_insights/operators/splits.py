"""Reproducible stratified split with exact class quotas.

Rows are ordered inside their class by ``md5(seed|row id)``, and the first
``quota`` rows go to validation.  Membership depends on the seed and the row id
only, never on partitioning.  Fitting counts rows per hash prefix, so only the rows
around the end of a quota are ranked; applying the fitted split is a plain projection.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_hash(row_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), row_id.cast("string")))


def class_quotas(counts: Mapping[object, int], test_size: float) -> dict[object, int]:
    """Validation rows per class: ``ceil(test_size * n)`` in all, by largest remainder of the training share."""
    total = sum(counts.values())
    n_train = total - math.ceil(test_size * total)
    # Whole numbers, so that no remainder is lost for very large counts.
    shares = {c: divmod(n * n_train, total) for c, n in counts.items()}
    train = {c: whole for c, (whole, _) in shares.items()}
    by_remainder = sorted(counts, key=lambda c: (-shares[c][1], c))
    for c in by_remainder[: n_train - sum(train.values())]:
        train[c] += 1
    return {c: counts[c] - train[c] for c in counts}


@dataclass(frozen=True)
class Split:
    """The last validation row of each class, by hash and id."""

    row_id: str
    label: str
    seed: int
    last_valid: dict[object, tuple[str, object]]

    def is_valid(self) -> Column:
        """True for validation rows."""
        digest, row, label = row_hash(F.col(self.row_id), self.seed), F.col(self.row_id), F.col(self.label)
        result = F.lit(False)
        for value, (last_hash, last_row) in self.last_valid.items():
            inside = (digest < last_hash) | ((digest == last_hash) & (row <= F.lit(last_row)))
            result = F.when(label == F.lit(value), inside).otherwise(result)
        return result

    def mark(self, df: DataFrame, out: str = "split") -> DataFrame:
        return df.withColumn(out, F.when(self.is_valid(), F.lit("valid")).otherwise(F.lit("train")))


def fit_split(
    df: DataFrame,
    row_id: str = "row_id",
    label: str = "y",
    test_size: float = 0.2,
    seed: int = 42,
    step_digits: int = 3,
    rank_at_most: int = 100_000,
) -> Split:
    """Find where each class's quota ends.

    Rows are counted per hash prefix, then per longer prefix inside the one where the
    quota ends, until few enough rows share it to be ranked one by one.  Every pass is
    a narrow scan with a small aggregate: the driver sees ``16 ** step_digits`` counts
    per class, and no task ranks more than ``rank_at_most`` rows of a class.
    """
    rows = df.select(
        F.col(label).alias("label"), F.col(row_id).alias("id"), row_hash(F.col(row_id), seed).alias("digest")
    )
    border: dict[object, Border] = {}
    for length in range(step_digits, 32 + step_digits, step_digits):
        inside = _any(b.holds(c) for c, b in border.items()) if border else F.lit(True)
        prefix = F.substring("digest", 1, length)
        counts: dict[object, dict[str, int]] = {}
        for r in rows.where(inside).groupBy("label", prefix.alias("prefix")).agg(F.count("*").alias("n")).collect():
            if r["label"] is None:
                raise ValueError(f"column {label} holds missing labels; a stratified split needs one in every row")
            counts.setdefault(r["label"], {})[r["prefix"]] = r["n"]
        if length == step_digits:
            quotas = class_quotas({c: sum(n.values()) for c, n in counts.items()}, test_size)
            border = {c: Border("", q) for c, q in quotas.items() if q > 0}
        border = {c: b.narrow(counts[c]) for c, b in border.items()}
        if all(b.size <= rank_at_most for b in border.values()):
            break
    place = Window.partitionBy("label").orderBy("digest", "id")
    ranked = rows.where(_any(b.holds(c) for c, b in border.items())).withColumn("rank", F.row_number().over(place))
    # The last row of the quota and the one behind it: equal ids would put both on one side.
    at_end = F.lit(False)
    for c, b in border.items():
        at_end = at_end | ((F.col("label") == F.lit(c)) & F.col("rank").isin(b.quota, b.quota + 1))
    ends: dict[object, list] = {}
    for r in ranked.where(at_end).orderBy("label", "rank").collect():
        ends.setdefault(r["label"], []).append((r["digest"], r["id"]))
    for c, found in ends.items():
        if len(found) == 2 and found[0] == found[1]:
            raise ValueError(f"column {row_id} is not unique: {found[0][1]!r} stands on both sides of the split of class {c!r}")
    return Split(row_id, label, seed, {c: found[0] for c, found in ends.items()})


@dataclass(frozen=True)
class Border:
    """The hash prefix in which a class's quota ends, and how many of its rows are still wanted."""

    prefix: str
    quota: int
    size: int = 0

    def holds(self, label: object) -> Column:
        return (F.col("label") == F.lit(label)) & F.col("digest").startswith(self.prefix)

    def narrow(self, counts: Mapping[str, int]) -> Border:
        """The longer prefix in which the quota ends; ``counts`` are the rows per longer prefix."""
        wanted = self.quota
        for prefix in sorted(counts):
            if counts[prefix] >= wanted:
                return Border(prefix, wanted, counts[prefix])
            wanted -= counts[prefix]
        raise ValueError("the counts do not reach the quota")


def _any(conditions) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def split_sizes(marked: DataFrame, label: str = "y", split: str = "split") -> DataFrame:
    return marked.groupBy(split, label).agg(F.count("*").alias("n"))
