"""The survey record: column names, roles, code lists and the declared schema."""

from __future__ import annotations

from pyspark.sql import types as T

LABEL = "label"
WEIGHT = "weight"

# ---------------------------------------------------------------------------
# Fixed values. They have to equal the survey's own vocabulary.
# ---------------------------------------------------------------------------

SURVEY_COLUMNS = [
    "age",
    "class of worker",
    "detailed industry recode",
    "detailed occupation recode",
    "education",
    "wage per hour",
    "enroll in edu inst last wk",
    "marital stat",
    "major industry code",
    "major occupation code",
    "race",
    "hispanic origin",
    "sex",
    "member of a labor union",
    "reason for unemployment",
    "full or part time employment stat",
    "capital gains",
    "capital losses",
    "dividends from stocks",
    "tax filer stat",
    "region of previous residence",
    "state of previous residence",
    "detailed household and family stat",
    "detailed household summary in household",
    "weight",
    "migration code-change in msa",
    "migration code-change in reg",
    "migration code-move within reg",
    "live in this house 1 year ago",
    "migration prev res in sunbelt",
    "num persons worked for employer",
    "family members under 18",
    "country of birth father",
    "country of birth mother",
    "country of birth self",
    "citizenship",
    "own business or self employed",
    "fill inc questionnaire for veteran's admin",
    "veterans benefits",
    "weeks worked in year",
    "year",
    "label",
]

# Text that means "missing" in any column of the raw file (the empty text too).
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

LABEL_CODES = {"- 50000.": 0, "50000+.": 1}

NOT_IN_UNIVERSE = "NIU"
YES_NO_CODES = {0: "NIU", 1: "Yes", 2: "No"}
YEAR_CODES = {94: "1994", 95: "1995"}

EDUCATION_LEVELS = [
    "Children",
    "Less than 1st grade",
    "1st 2nd 3rd or 4th grade",
    "5th or 6th grade",
    "7th and 8th grade",
    "9th grade",
    "10th grade",
    "11th grade",
    "12th grade no diploma",
    "High school graduate",
    "Some college but no degree",
    "Associate degree-occupational/vocational",
    "Associate degree-academic program",
    "Bachelors degree(BA AB BS)",
    "Masters degree(MA MS MEng MEd MSW MBA)",
    "Professional school degree (MD DDS DVM LLB JD)",
    "Doctorate degree(PhD EdD)",
]

STUDENT_STATUSES = ["High school", "College or university"]

# (inclusive upper bound, band name); the last band is open.
AGE_BANDS = [(17, "<18"), (24, "18-24"), (34, "25-34"), (44, "35-44"), (54, "45-54"), (64, "55-64"), (None, "65+")]
WEEKS_BANDS = [(0, "0"), (13, "1-13"), (26, "14-26"), (39, "27-39"), (47, "40-47"), (None, "48-52+")]

NUMERIC_COLUMNS = [
    "age",
    "wage per hour",
    "capital gains",
    "capital losses",
    "dividends from stocks",
    "weeks worked in year",
    "num persons worked for employer",
    "weight",
]
YES_NO_COLUMNS = ["own business or self employed", "veterans benefits"]
ZERO_IS_NIU_COLUMNS = ["detailed industry recode", "detailed occupation recode"]
YEAR_COLUMN = "year"

# Roles in the classification feature matrix; every other numeric column is robust-scaled.
CLASSIFY_SKEWED = ["wage per hour", "capital gains", "capital losses", "dividends from stocks"]
CLASSIFY_UNSCALED = ["weeks worked in year", "num persons worked for employer", "education_ord"]
CLASSIFY_SCALED_FIRST = ["age"]

# Roles in the segmentation feature matrix.
SEGMENT_NUMERIC = [
    "age",
    "weeks worked in year",
    "wage per hour",
    "capital gains",
    "capital losses",
    "dividends from stocks",
    "num persons worked for employer",
]
SEGMENT_SKEWED = ["capital gains", "capital losses", "dividends from stocks"]
SEGMENT_CATEGORICAL = [
    "class of worker",
    "detailed industry recode",
    "detailed occupation recode",
    "marital stat",
    "major industry code",
    "major occupation code",
    "race",
    "hispanic origin",
    "sex",
    "member of a labor union",
    "reason for unemployment",
    "full or part time employment stat",
    "tax filer stat",
    "region of previous residence",
    "state of previous residence",
    "detailed household and family stat",
    "detailed household summary in household",
    "migration code-change in msa",
    "migration code-change in reg",
    "migration code-move within reg",
    "live in this house 1 year ago",
    "migration prev res in sunbelt",
    "family members under 18",
    "country of birth father",
    "country of birth mother",
    "country of birth self",
    "citizenship",
    "fill inc questionnaire for veteran's admin",
    "veterans benefits",
]

# What the segment profile shows.
PROFILE_MEANS = ["age", "weeks worked in year", "wage per hour", "num persons worked for employer"]
PROFILE_CROSSTABS = [
    "age_band",
    "education",
    "class of worker",
    "marital stat",
    "full or part time employment stat",
    "sex",
    "major industry code",
    "major occupation code",
    "race",
    "hispanic origin",
    "tax filer stat",
    "citizenship",
    "detailed industry recode",
    "detailed occupation recode",
    "weeks_band",
]
PROFILE_TOP_CATEGORIES = [
    "age_band",
    "education",
    "class of worker",
    "marital stat",
    "full or part time employment stat",
    "sex",
    "major industry code",
    "major occupation code",
    "detailed industry recode",
    "detailed occupation recode",
    "race",
    "hispanic origin",
    "member of a labor union",
    "tax filer stat",
    "citizenship",
    "enroll in edu inst last wk",
    "reason for unemployment",
    "detailed household and family stat",
    "detailed household summary in household",
    "family members under 18",
    "region of previous residence",
    "state of previous residence",
    "migration code-change in msa",
    "migration code-change in reg",
    "migration code-move within reg",
    "live in this house 1 year ago",
    "migration prev res in sunbelt",
    "country of birth father",
    "country of birth mother",
    "country of birth self",
    "own business or self employed",
    "veterans benefits",
    "fill inc questionnaire for veteran's admin",
    "year",
    "weeks_band",
]

# ---------------------------------------------------------------------------


def text_schema(names: list[str] = SURVEY_COLUMNS) -> T.StructType:
    """Every field as text: typing happens after the missing tokens are recognised."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])
