"""Exact order statistics of many columns, linearly interpolated, at any number of rows.

One scan summarises the columns: counts, moments, and even quantiles of each of a fixed number of groups of tasks.  These bracket every
wanted rank.  Another scan counts the values inside the brackets one by one, everything outside collapses onto a mark beside a
bracket, and the running counts give the exact order statistics.  Only while a bracket may hold too many values are the
brackets narrowed first, by the same kind of summary.  A rank that falls on a mark would mean that a summary was wrong,
and raises.  NaN is missing.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .longform import aggregate_long

#: Even quantiles per group, and groups: what one column sends to the driver.
GRID = 256
GROUPS = 64
#: Values of a bracket that are counted one by one.
MOST = 200_000


def as_number(column: Column) -> Column:
    """A double; NaN counts as missing."""
    number = column.cast("double")
    return F.when(~F.isnan(number), number)


@dataclass(frozen=True)
class Points:
    """Values and how many values (nearly) lie at or below each; ``slack`` bounds the error."""

    values: np.ndarray
    upto: np.ndarray
    slack: float

    def bracket(self, rank: int) -> tuple[float, float]:
        """Bounds that hold the value of a rank."""
        low = int(np.searchsorted(self.upto, rank - self.slack, side="right")) - 1
        high = int(np.searchsorted(self.upto, rank + 1 + self.slack, side="left"))
        return (float(self.values[low]) if low >= 0 else -math.inf, float(self.values[high]) if high < len(self.values) else math.inf)


@dataclass(frozen=True)
class Summary:
    """What one scan tells about a column."""

    rows: int
    filled: int
    mean: float
    deviation: float
    points: Points


def _grid(value: Column) -> Column:
    steps = F.array([F.lit(i / GRID) for i in range(GRID + 1)])
    return F.percentile_approx(value, steps, F.lit(4 * GRID))


def _group() -> Column:
    return F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("_group")


def _pooled(grids: Sequence[tuple[int, Sequence[float] | None]]) -> Points:
    """The quantiles of all groups as one cumulative count."""
    held = [(n, grid) for n, grid in grids if n]
    values = np.concatenate([np.array(grid) for _, grid in held]) if held else np.zeros(0)
    weights = np.concatenate([np.full(len(grid), n / len(grid)) for n, grid in held]) if held else np.zeros(0)
    order = np.argsort(values, kind="stable")
    # A grid's own step, the sketch's error of a quarter of it, and rounding in every group.
    return Points(values[order], np.cumsum(weights[order]), 1.5 * sum(n for n, _ in held) / GRID + 2 * len(held))


def summarise(df: DataFrame, numbers: Mapping[str, Column]) -> dict[str, Summary]:
    """One scan over all columns; ``GROUPS`` rows reach the driver."""
    if not numbers:
        return {}
    values = df.select([as_number(number).alias(f"c{i}") for i, number in enumerate(numbers.values())])
    measures = [F.count("*").alias("rows")]
    for i in range(len(numbers)):
        c = F.col(f"c{i}")
        measures += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.var_pop(c).alias(f"v{i}"), F.min(c).alias(f"a{i}"), F.max(c).alias(f"z{i}"), _grid(c).alias(f"g{i}")]
    parts = sorted(values.groupBy(_group()).agg(*measures).collect(), key=lambda r: r["_group"])
    rows, out = sum(r["rows"] for r in parts), {}
    for i, name in enumerate(numbers):
        some = [r for r in parts if r[f"n{i}"]]
        n = sum(r[f"n{i}"] for r in some)
        mean, spread = _moments([(r[f"n{i}"], r[f"m{i}"], r[f"v{i}"] * r[f"n{i}"]) for r in some])
        if some and min(r[f"a{i}"] for r in some) == max(r[f"z{i}"] for r in some):
            mean, spread = some[0][f"a{i}"], 0.0
        out[name] = Summary(rows, n, mean, math.sqrt(spread / n) if n else 0.0, _pooled([(r[f"n{i}"], r[f"g{i}"]) for r in some]))
    return out


def _moments(parts: Sequence[tuple[int, float, float]]) -> tuple[float, float]:
    """Mean, and sum of squared deviations from it, of all parts ``(n, mean, sum of squares)``."""
    count, mean, spread = 0, 0.0, 0.0
    for n, m, s in parts:
        gap, whole = m - mean, count + n
        mean += gap * n / whole
        spread += s + gap * gap * count * n / whole
        count = whole
    return mean, spread


def order_statistics(
    df: DataFrame, numbers: Mapping[str, Column], summaries: Mapping[str, Summary], ranks: Mapping[str, Collection[int]]
) -> dict[str, dict[int, float]]:
    """``{name: {rank: value}}`` for the wanted ranks (0 is the smallest value) of every column."""
    names = [name for name in numbers if ranks.get(name)]
    if not names:
        return {}
    short = {name: f"c{i}" for i, name in enumerate(names)}
    values = df.select([as_number(numbers[name]).alias(c) for name, c in short.items()])
    brackets = {short[n]: {r: summaries[n].points.bracket(r) for r in ranks[n]} for n in names}
    brackets = _narrowed(values, brackets, {short[n]: 4 * summaries[n].points.slack for n in names})
    merged = {c: _merged(b.values()) for c, b in brackets.items()}
    narrowed = {c: _collapse(F.col(c), merged[c]) for c in merged}
    counted = aggregate_long(values, narrowed, F.count("*"), "n", value="value", keep_missing=False).collect()
    found: dict[str, dict[int, float]] = {}
    for name in names:
        c = short[name]
        rows = sorted((r["value"], r["n"]) for r in counted if r["attribute"] == c)
        ends = np.cumsum([n for _, n in rows])
        found[name] = {}
        for rank in ranks[name]:
            at = int(np.searchsorted(ends, rank, side="right"))
            value = rows[at][0] if at < len(rows) else math.nan
            if not any(low <= value <= high for low, high in merged[c]):
                raise RuntimeError(f"rank {rank} of {name} lies outside its bracket")
            found[name][rank] = value
    return found


def _narrowed(values: DataFrame, brackets: dict[str, dict[int, tuple[float, float]]], held: dict[str, float]) -> dict[str, dict[int, tuple[float, float]]]:
    """Brackets with at most some ``MOST`` values each, or as few as their ties allow."""
    while True:
        wide = [(c, r, *b) for c, found in brackets.items() if held[c] > MOST for r, b in found.items() if b[0] < b[1]]
        if not wide:
            return brackets
        measures = []
        for i, (c, _, low, high) in enumerate(wide):
            inside = F.when((F.col(c) >= low) & (F.col(c) <= high), F.col(c))
            measures += [F.count(F.when(F.col(c) < low, 1)).alias(f"b{i}"), F.count(inside).alias(f"n{i}"), _grid(inside).alias(f"g{i}")]
        parts = values.groupBy(_group()).agg(*measures).collect()
        fresh = {c: dict(found) for c, found in brackets.items()}
        now = dict.fromkeys(held, 0.0)
        for i, (c, rank, low, high) in enumerate(wide):
            points = _pooled([(r[f"n{i}"], r[f"g{i}"]) for r in parts])
            a, b = points.bracket(rank - sum(r[f"b{i}"] for r in parts))
            fresh[c][rank] = max(a, low), min(b, high)
            now[c] = max(now[c], 4 * points.slack)
        # Ties that fill a bracket cannot be narrowed; they are few values.
        held = {c: now[c] if now[c] < held[c] / 2 else 0.0 for c in held}
        brackets = fresh


def _merged(pairs: Collection[tuple[float, float]]) -> list[tuple[float, float]]:
    """Sorted value ranges that do not touch."""
    merged: list[tuple[float, float]] = []
    for low, high in sorted(pairs):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _collapse(value: Column, brackets: Sequence[tuple[float, float]]) -> Column:
    """The value itself inside a bracket, else a mark just above the bracket below it (-inf below all)."""
    collapsed = F.lit(-math.inf)
    for low, high in brackets:
        collapsed = F.when(value > high, F.lit(math.nextafter(high, math.inf))).when(value >= low, value).otherwise(collapsed)
    return F.when(value.isNotNull(), collapsed)


def neighbours(q: float, n: int) -> tuple[int, int, float]:
    """Ranks below and above quantile ``q`` of ``n`` values, and the weight of the upper one."""
    position = q * (n - 1)
    low = math.floor(position)
    return low, min(low + 1, n - 1), position - low


def exact_quantiles(df: DataFrame, numbers: Mapping[str, Column], probabilities: Sequence[float]) -> dict[str, list[float] | None]:
    """``{name: [quantile per probability]}``; None for a column without any value."""
    summaries = summarise(df, numbers)
    ranks = {name: {r for q in probabilities for r in neighbours(q, s.filled)[:2]} for name, s in summaries.items() if s.filled}
    found = order_statistics(df, numbers, summaries, ranks)
    result: dict[str, list[float] | None] = dict.fromkeys(numbers)
    for name, at in found.items():
        result[name] = []
        for q in probabilities:
            low, high, part = neighbours(q, summaries[name].filled)
            result[name].append(at[low] + (at[high] - at[low]) * part)
    return result
