"""Feature preparation: statistics are fitted on one frame and applied to any other.

The statistics are unweighted.  Fitted constants become literals, so applying a
fitted preparation is a projection, and the stock MLlib pipeline built from them
saves and loads without any code of its own.

MLlib's imputer, scalers and encoder defaults give other answers (an approximate
median, sample deviation, a zero for a zero range), so the constants are computed here.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import survey
from ..functions.cleaning import present, quoted
from ..storage import new_path, settle
from .dictionary import DictionaryIndexer, number_categories
from .longform import aggregate_long
from .quantiles import Summary, as_number, neighbours, order_statistics, summarise

# A step turns the SQL text of a number into the SQL text of another number.
Step = Callable[[str], str]

QUARTILES = [0.25, 0.5, 0.75]
#: Categories of all columns together that may pass through the driver, and of one column if they are more.
MOST_CATEGORIES = 100_000
NARROW = 1_000


def clip_step(number: str) -> str:
    return f"greatest({number}, 0D)"


def log1p_step(number: str) -> str:
    return f"log1p({number})"


@dataclass(frozen=True)
class FeatureSpec:
    """Which column is prepared how.  The order of the groups is the order of the features."""

    skewed: tuple[str, ...] = ()  # impute, steps, robust scale
    unscaled: tuple[str, ...] = ()  # impute
    robust: tuple[str, ...] = ()  # impute, robust scale
    standard: tuple[str, ...] = ()  # impute, standard scale
    categorical: tuple[str, ...] = ()  # impute, one-hot
    skew_steps: tuple[Step, ...] = (clip_step, log1p_step)

    @property
    def numeric(self) -> tuple[str, ...]:
        return self.skewed + self.unscaled + self.robust + self.standard

    @property
    def columns(self) -> tuple[str, ...]:
        return self.numeric + self.categorical


def spec_by_type(
    df: DataFrame,
    exclude: Sequence[str] = (),
    skewed: Sequence[str] = survey.CLASSIFY_SKEWED,
    unscaled: Sequence[str] = survey.CLASSIFY_UNSCALED,
    scaled_first: Sequence[str] = survey.CLASSIFY_SCALED_FIRST,
) -> FeatureSpec:
    """Roles by column type: numbers go to their group, the rest (flags too) is categorical."""
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name not in exclude:
            (numeric if isinstance(f.dataType, T.NumericType) else categorical).append(f.name)
    skew = [c for c in skewed if c in numeric]
    plain = [c for c in unscaled if c in numeric]
    first = [c for c in scaled_first if c in numeric]
    rest = [c for c in numeric if c not in {*skew, *plain, *first}]
    return FeatureSpec(
        skewed=tuple(skew), unscaled=tuple(plain), robust=tuple(first + rest), categorical=tuple(categorical)
    )


def segment_spec(df: DataFrame) -> FeatureSpec:
    """The fixed segmentation features that ``df`` has."""
    numeric = present(df, survey.SEGMENT_NUMERIC)
    return FeatureSpec(
        skewed=tuple(c for c in survey.SEGMENT_SKEWED if c in numeric),
        standard=tuple(c for c in numeric if c not in survey.SEGMENT_SKEWED),
        categorical=tuple(present(df, survey.SEGMENT_CATEGORICAL)),
    )


def _number(value: float) -> str:
    return f"{float(value)!r}D"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


@dataclass(frozen=True)
class NumericFit:
    name: str
    median: float
    steps: tuple[Step, ...] = ()
    center: float = 0.0
    scale: float = 1.0

    def prepared(self) -> str:
        """SQL text of the imputed and stepped, but unscaled, number."""
        text = f"coalesce(nanvl(CAST({_name(self.name)} AS DOUBLE), NULL), {_number(self.median)})"
        for step in self.steps:
            text = step(text)
        return text

    def scaled(self) -> str:
        return f"({self.prepared()} - {_number(self.center)}) / {_number(self.scale)}"


@dataclass(frozen=True)
class CategoricalFit:
    """The mode, and the sorted categories; of a wide vocabulary (``dictionary``: its table) the number of categories only."""

    name: str
    mode: str
    categories: tuple[str, ...]
    wide: int = 0
    dictionary: str = ""

    @property
    def size(self) -> int:
        """Categories."""
        return self.wide or len(self.categories)

    @property
    def width(self) -> int:
        """Features."""
        return 1 if self.is_binary else self.size

    def imputed(self) -> str:
        return f"coalesce(CAST({_name(self.name)} AS STRING), {_text(self.mode)})"

    @property
    def is_binary(self) -> bool:
        return len(self.categories) == 2

    def feature_names(self) -> list[str]:
        """Names in feature order; those of a wide vocabulary stand in its table and are numbered here."""
        if self.wide:
            return [f"{self.name}#{i}" for i in range(self.wide)]
        kept = self.categories[1:] if self.is_binary else self.categories
        return [f"{self.name}={category}" for category in kept]


@dataclass(frozen=True)
class FittedPrep:
    """Fitted constants: one entry per column that has any value."""

    numeric: tuple[NumericFit, ...] = ()
    categorical: tuple[CategoricalFit, ...] = ()
    features: str = field(default="features")

    @property
    def feature_names(self) -> list[str]:
        names = [n.name for n in self.numeric]
        for c in self.categorical:
            names += c.feature_names()
        return names

    @property
    def groups(self) -> list[tuple[int, int]]:
        """First feature of every one-hot group, and the one behind its last."""
        out, at = [], len(self.numeric)
        for c in self.categorical:
            if not c.is_binary:
                out.append((at, at + c.width))
            at += c.width
        return out

    @property
    def n_features(self) -> int:
        return len(self.numeric) + sum(c.width for c in self.categorical)

    def imputed(self, df: DataFrame) -> DataFrame:
        """Replace missing values by the medians and modes, leaving all else as it is."""
        made = {n.name: F.expr(replace(n, steps=()).prepared()) for n in self.numeric}
        made.update({c.name: F.expr(c.imputed()) for c in self.categorical})
        return df.select([made.get(c, quoted(c)).alias(c) for c in df.columns])

    def scaled(self, df: DataFrame) -> DataFrame:
        """The numeric columns in their final form; other columns unchanged."""
        made = {n.name: F.expr(n.scaled()) for n in self.numeric}
        return df.select([made.get(c, quoted(c)).alias(c) for c in df.columns])

    def pipeline(self, df: DataFrame) -> PipelineModel:
        """Stock MLlib stages that add the feature vector to frames shaped like ``df``."""
        numbers = [(n.scaled(), f"_n{i}") for i, n in enumerate(self.numeric)]
        texts, wide, parts = [], [], [name for _, name in numbers]
        for i, c in enumerate(self.categorical):
            if c.is_binary:
                numbers.append((f"CAST({c.imputed()} = {_text(c.categories[1])} AS DOUBLE)", f"_b{i}"))
                parts.append(f"_b{i}")
            else:
                texts.append((c.imputed(), f"_c{i}"))
                wide.append((i, c))
                parts.append(f"_o{i}")
        made = ", ".join(f"{text} AS {name}" for text, name in numbers + texts)
        stages = [SQLTransformer(statement=f"SELECT *, {made} FROM __THIS__")]
        empty = stages[0].transform(df.limit(0))
        if wide:
            # The extra slot for unseen values is the one the encoder drops: unseen means all zeros.
            # (One indexer per column: several label lists in one would be padded to equal length.)
            for i, c in wide:
                if c.wide:
                    index = DictionaryIndexer(c.dictionary, c.name, c.wide, f"_c{i}", f"_i{i}")
                else:
                    index = StringIndexerModel.from_labels(
                        list(c.categories), inputCol=f"_c{i}", outputCol=f"_i{i}", handleInvalid="keep"
                    )
                empty = index.transform(empty)
                stages.append(index)
            hot = OneHotEncoder(
                inputCols=[f"_i{i}" for i, _ in wide], outputCols=[f"_o{i}" for i, _ in wide], dropLast=True
            )
            stages.append(hot.fit(empty))
        stages.append(VectorAssembler(inputCols=parts, outputCol=self.features))
        return PipelineModel(stages)

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` columns and the feature vector."""
        return self.pipeline(df).transform(df).select(*[quoted(c) for c in keep], self.features)


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(attribute, category, n)`` for all columns in one shuffle; missing values are not counted."""
    texts = {c: quoted(c).cast("string") for c in columns}
    return aggregate_long(df, texts, F.count("*"), "n", keep_missing=False)


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The most frequent category of each column (ties: the smallest); one row per column reaches the driver."""
    counts = category_counts(df, columns).groupBy("attribute", "category").agg(F.sum("n").alias("n"))
    most = counts.groupBy("attribute").agg(F.max("n").alias("n"))
    best = counts.join(most, ["attribute", "n"]).groupBy("attribute").agg(F.min("category").alias("mode"))
    return {r["attribute"]: r["mode"] for r in best.collect()}


def fit_categories(df: DataFrame, columns: Sequence[str], encode: bool = True) -> tuple[CategoricalFit, ...]:
    """Sorted categories and the most frequent one (ties: the smallest); empty columns are left out.

    Without ``encode`` only the most frequent category is looked for.  Vocabularies pass through the driver as long as they
    have at most ``MOST_CATEGORIES`` categories together; beyond that those of over ``NARROW`` stay a table (see ``dictionary.py``).
    """
    if not columns:
        return ()
    if not encode:
        modes = fit_modes(df, columns)
        return tuple(CategoricalFit(c, modes[c], ()) for c in columns if c in modes)
    counts = category_counts(df, columns)
    rows = counts.limit(MOST_CATEGORIES + 1).collect()
    if len(rows) > MOST_CATEGORIES:
        return _fit_wide(settle(counts, "category-counts"), columns)
    found: dict[str, list[tuple[str, int]]] = {}
    for r in rows:
        found.setdefault(r["attribute"], []).append((r["category"], r["n"]))
    fits = []
    for c in columns:
        if c in found:
            ordered = sorted(found[c])
            mode = max(ordered, key=lambda pair: pair[1])[0]
            fits.append(CategoricalFit(c, mode, tuple(name for name, _ in ordered)))
    return tuple(fits)


def _fit_wide(counts: DataFrame, columns: Sequence[str]) -> tuple[CategoricalFit, ...]:
    """One row per column reaches the driver, the categories of narrow columns, and nothing of the wide ones."""
    most = counts.groupBy("attribute").agg(F.count("*").alias("size"), F.max("n").alias("n"))
    modes = counts.join(most, ["attribute", "n"]).groupBy("attribute").agg(F.min("category").alias("mode"), F.max("size").alias("size"))
    facts = {r["attribute"]: (r["mode"], r["size"]) for r in modes.collect()}
    wide = [c for c, (_, size) in facts.items() if size > NARROW]
    narrow: dict[str, list[str]] = {}
    for r in counts.where(~F.col("attribute").isin(wide)).collect():
        narrow.setdefault(r["attribute"], []).append(r["category"])
    # The table belongs to the fitted model and stays.
    path = new_path(counts.sparkSession, "dictionary")
    number_categories(counts.where(F.col("attribute").isin(wide))).write.parquet(path)
    return tuple(
        CategoricalFit(c, facts[c][0], (), facts[c][1], path) if c in wide else CategoricalFit(c, facts[c][0], tuple(sorted(narrow[c])))
        for c in columns
        if c in facts
    )


def _between(values: Sequence[float], part: float) -> float:
    low, high = values
    return low + (high - low) * part


def _filled_ranks(q: float, summary: Summary) -> list[tuple[int, int]]:
    """For both neighbours of a quantile of the imputed column: the ranks, among the values, of what can stand there.

    The missing ones form a run of equal values somewhere in the order.  At rank r stands the value of rank r if that run lies
    above, that of rank r less the run if it lies below, and the median inside the run.
    """
    missing = summary.rows - summary.filled
    low, high, _ = neighbours(q, summary.rows)
    return [(r - missing, r) for r in (low, high)]


def _after_steps(spark: SparkSession, steps: Sequence[Step], values: Sequence[float]) -> list[float]:
    """The steps applied to some numbers, by the same engine that applies them to the rows."""
    texts = []
    for value in values:
        text = f"CAST('{value!r}' AS DOUBLE)"
        for step in steps:
            text = step(text)
        texts.append(text)
    return list(spark.sql(f"SELECT {', '.join(texts)}").first()) if texts else []


def fit_numeric(df: DataFrame, spec: FeatureSpec) -> tuple[NumericFit, ...]:
    """Medians and scales of all numeric columns from two scans.

    Imputing puts equal values into the order, clip and log keep the order, so every order statistic of a prepared column is that of
    one or two raw values.  ``spec.skew_steps`` must not decrease.
    """
    numbers = {c: as_number(quoted(c)) for c in spec.numeric}
    summaries = {c: s for c, s in summarise(df, numbers).items() if s.filled}
    ranks: dict[str, set[int]] = {c: set(neighbours(0.5, s.filled)[:2]) for c, s in summaries.items()}
    for c in summaries:
        if c in spec.skewed + spec.robust:
            wanted = {r for q in QUARTILES for pair in _filled_ranks(q, summaries[c]) for r in pair}
            ranks[c] |= {r for r in wanted if 0 <= r < summaries[c].filled}
    found = order_statistics(df, numbers, summaries, ranks)
    fits = []
    for c in spec.numeric:
        if c not in summaries:
            continue
        summary, at = summaries[c], found[c]
        low, high, part = neighbours(0.5, summary.filled)
        fit = NumericFit(c, _between((at[low], at[high]), part), spec.skew_steps if c in spec.skewed else ())
        if c in spec.skewed + spec.robust:
            ends = []
            for q in QUARTILES:
                for below, above in _filled_ranks(q, summary):
                    ends.append(min(max(fit.median, at.get(below, -math.inf)), at.get(above, math.inf)))
            ends = _after_steps(df.sparkSession, fit.steps, ends) if fit.steps else ends
            first, middle, third = (_between(ends[2 * i : 2 * i + 2], neighbours(q, summary.rows)[2]) for i, q in enumerate(QUARTILES))
            fit = replace(fit, center=middle, scale=(third - first) or 1.0)
        elif c in spec.standard:
            missing = summary.rows - summary.filled
            gap = fit.median - summary.mean
            spread = summary.deviation**2 * summary.filled + gap * gap * summary.filled * missing / summary.rows
            fit = replace(fit, center=summary.mean + gap * missing / summary.rows, scale=math.sqrt(spread / summary.rows) or 1.0)
        fits.append(fit)
    return tuple(fits)


def fit_prep(df: DataFrame, spec: FeatureSpec, features: str = "features", encode: bool = True) -> FittedPrep:
    """Fit medians, scales and (with ``encode``) vocabularies on ``df`` (the training rows).  NaN is missing."""
    return FittedPrep(fit_numeric(df, spec), fit_categories(df, spec.categorical, encode), features)
