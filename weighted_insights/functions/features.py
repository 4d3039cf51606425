"""Derived columns, bands and the small numeric helpers.  Column expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import survey
from .cleaning import present, quoted, to_double


def ordinal(value: Column, levels: Sequence[str]) -> Column:
    """Position of ``value`` in an ordered list of levels, from 0; NULL if it is not listed."""
    position = F.array_position(F.array([F.lit(level) for level in levels]), value)
    return F.when(position > 0, position - 1).cast("bigint")


def number_or_zero(number: Column) -> Column:
    return F.coalesce(number, F.lit(0.0))


def is_positive(number: Column) -> Column:
    return number_or_zero(number) > 0


def equals_or_false(number: Column, wanted: float) -> Column:
    return F.coalesce(number == F.lit(float(wanted)), F.lit(False))


def one_of_or_false(value: Column, wanted: Sequence[str]) -> Column:
    return F.coalesce(value.isin(list(wanted)), F.lit(False))


def investment_income(gains: Column, losses: Column, dividends: Column) -> Column:
    return number_or_zero(dividends) + number_or_zero(gains) - number_or_zero(losses)


def band(number: Column, bands: Sequence[tuple[float | None, str]]) -> Column:
    """Name of the band a number falls in.  Upper bounds belong to their band; NULL has no band."""
    name = F.lit(bands[-1][1])
    for upper, label in reversed(bands[:-1]):
        name = F.when(number <= upper, F.lit(label)).otherwise(name)
    return F.when(number.isNotNull(), name)


def age_band(number: Column) -> Column:
    return band(number, survey.AGE_BANDS)


def weeks_band(number: Column) -> Column:
    return band(number, survey.WEEKS_BANDS)


def category_or_na(value: Column) -> Column:
    """A category as text for profiles, where missing is a category of its own."""
    return F.coalesce(value.cast("string"), F.lit("NA"))


def clip_at_zero(number: Column) -> Column:
    """``max(number, 0)`` that keeps NULL (``greatest`` alone would skip it)."""
    return F.when(number < 0, F.lit(0.0)).otherwise(number)


def sigmoid(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def share_text(category: Column, share: Column) -> Column:
    """``name (12.34%)``"""
    return F.format_string("%s (%.2f%%)", category, (share * 100).cast("double"))


def guarded(total: Column) -> Column:
    """A denominator: the total if it is positive, else 1."""
    return F.when(total > 0, total).otherwise(F.lit(1.0))


def derive(df: DataFrame) -> DataFrame:
    """Add the derived columns whose inputs are present, in one projection."""
    added: dict[str, Column] = {}
    have = set(df.columns)
    if "education" in have:
        added["education_ord"] = ordinal(quoted("education"), survey.EDUCATION_LEVELS)
    if "wage per hour" in have:
        added["has_wage"] = is_positive(to_double(df, "wage per hour"))
    if {"capital gains", "capital losses", "dividends from stocks"} <= have:
        income = investment_income(
            to_double(df, "capital gains"), to_double(df, "capital losses"), to_double(df, "dividends from stocks")
        )
        added["invest_income"] = income
        added["has_invest_income"] = income > 0
    if "weeks worked in year" in have:
        weeks = to_double(df, "weeks worked in year")
        added["worked_any_weeks"] = is_positive(weeks)
        added["full_year_52w"] = equals_or_false(weeks, 52)
    if "enroll in edu inst last wk" in have:
        added["is_student"] = one_of_or_false(quoted("enroll in edu inst last wk"), survey.STUDENT_STATUSES)
    return df.withColumns(added)


def add_bands(df: DataFrame) -> DataFrame:
    """Add ``age_band`` and ``weeks_band`` where their inputs are present."""
    makers = {"age": ("age_band", age_band), "weeks worked in year": ("weeks_band", weeks_band)}
    return df.withColumns({makers[c][0]: makers[c][1](to_double(df, c)) for c in present(df, makers)})
