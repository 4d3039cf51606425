"""Row-wise typing and recoding.  Column expressions only: no shuffle, no Python at run time."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import survey

# What counts as a number in text.  Guards the cast: Java also reads '1d', '1f' and hexadecimal floats.
NUMBER_PATTERN = r"(?i)^[+-]?(([0-9]+([.][0-9]*)?|[.][0-9]+)(e[+-]?[0-9]+)?|inf|infinity)$"


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The listed columns that ``df`` has, in the listed order."""
    have = set(df.columns)
    return [name for name in names if name in have]


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def missing_to_null(value: Column, tokens: Iterable[str] = survey.MISSING_TOKENS) -> Column:
    """Text that means "missing" becomes NULL; nothing is trimmed, so ' NA' stays data."""
    return F.when(~value.isin(list(tokens)), value)


def text_to_double(value: Column) -> Column:
    """A number in text, or NULL."""
    bare = F.trim(value)
    return F.when(bare.rlike(NUMBER_PATTERN), bare.try_cast("double"))


def to_double(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a double; unreadable text and NaN are NULL."""
    value = quoted(name)
    if is_text(df, name):
        return text_to_double(value)
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def to_code(number: Column) -> Column:
    """An integral double as a bigint.  A fraction is not a code, so it is NULL."""
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def map_code(code: Column, mapping: Mapping[int, str], default: str | None = None) -> Column:
    """Look ``code`` up in a short list; codes outside it (and NULL) give ``default``."""
    keys = [F.lit(key).cast("bigint") for key in mapping]
    found = F.lit(default).cast("string")
    for key, name in reversed(list(zip(keys, mapping.values()))):
        found = F.when(code == key, F.lit(name)).otherwise(found)
    return found


def yes_no(code: Column) -> Column:
    return map_code(code, survey.YES_NO_CODES, survey.NOT_IN_UNIVERSE)


def zero_is_niu(code: Column) -> Column:
    return F.when(code.isNull() | (code == 0), F.lit(survey.NOT_IN_UNIVERSE)).otherwise(code.cast("string"))


def survey_year(code: Column) -> Column:
    return map_code(code, survey.YEAR_CODES)


def strict_label(value: Column, mapping: Mapping[str, int] = survey.LABEL_CODES) -> Column:
    """The class code; a label outside the list, or a missing one, fails the job."""
    code = F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(value, F.lit("missing")))).cast("int")
    for name, number in reversed(list(mapping.items())):
        code = F.when(value == name, F.lit(number)).otherwise(code)
    return code


def weight_or_zero(number: Column) -> Column:
    return F.coalesce(number, F.lit(0.0))


def drop_missing_tokens(df: DataFrame) -> DataFrame:
    """Apply :func:`missing_to_null` to every text column."""
    return df.select(
        [missing_to_null(quoted(c)).alias(c) if is_text(df, c) else quoted(c) for c in df.columns]
    )


def clean(df: DataFrame) -> DataFrame:
    """Type and recode the survey columns that are present.

    Three narrow projections, so that every text is parsed once although its code
    is looked at several times.
    """
    recodes = {
        **{name: yes_no for name in present(df, survey.YES_NO_COLUMNS)},
        **{name: zero_is_niu for name in present(df, survey.ZERO_IS_NIU_COLUMNS)},
        **{name: survey_year for name in present(df, [survey.YEAR_COLUMN])},
    }
    parsed = [*present(df, survey.NUMERIC_COLUMNS), *recodes]
    numbers = df.select([(to_double(df, c) if c in parsed else quoted(c)).alias(c) for c in df.columns])
    codes = numbers.select([(to_code(quoted(c)) if c in recodes else quoted(c)).alias(c) for c in df.columns])
    return codes.select([(recodes[c](quoted(c)) if c in recodes else quoted(c)).alias(c) for c in df.columns])


def label_and_weight(
    df: DataFrame, label: str = survey.LABEL, weight: str = survey.WEIGHT, y: str = "y", w: str = "w"
) -> DataFrame:
    """Replace the raw label and weight by the typed columns ``y`` and ``w``."""
    features = [quoted(c) for c in df.columns if c not in (label, weight)]
    return df.select(
        *features,
        strict_label(quoted(label)).alias(y),
        weight_or_zero(to_double(df, weight)).alias(w),
    )
