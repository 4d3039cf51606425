"""Reading the headerless survey file and naming its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import survey
from ..functions.cleaning import drop_missing_tokens, quoted


#: Types that a text column can turn out to have, narrowest first.
KINDS = ("int", "bigint", "double")


def read_column_names(spark: SparkSession, path: str) -> list[str]:
    """One name per line, in file order; blank lines are skipped and names trimmed."""
    lines = spark.read.text(path, wholetext=True).first()
    return [name.strip() for name in (lines.value if lines else "").splitlines() if name.strip()]


def read_survey(
    spark: SparkSession, path: str, names: list[str] | None = None, infer_types: bool = False
) -> DataFrame:
    """The survey file as text columns with missing tokens as NULL.

    Values are not trimmed, short rows are padded with NULL, and the file stays
    splittable.  ``infer_types`` asks Spark for a type per column instead.
    """
    names = names or survey.SURVEY_COLUMNS
    options = {"header": False, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    raw = drop_missing_tokens(spark.read.options(**options).schema(survey.text_schema(names)).csv(path))
    return with_inferred_types(raw) if infer_types else raw


def with_inferred_types(df: DataFrame) -> DataFrame:
    """Text columns as whole numbers or doubles where every value present is one; a column without any value is whole numbers.

    Missing tokens are NULL by then, so each of them leaves a column of numbers a column of numbers.
    """
    measures = []
    for i, name in enumerate(df.columns):
        text = quoted(name)
        for kind in KINDS:
            # Java reads 1d and 1f as numbers; a survey does not.
            wrong = text.isNotNull() & (text.try_cast(kind).isNull() | text.rlike("(?i)[df]$"))
            measures.append(F.count(F.when(wrong, 1)).alias(f"{kind}_{i}"))
    row = df.agg(*measures).first()
    made = []
    for i, name in enumerate(df.columns):
        kind = next((k for k in KINDS if not row[f"{k}_{i}"]), None)
        made.append(quoted(name).cast(kind).alias(name) if kind else quoted(name))
    return df.select(made)


def with_row_id(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Number the rows 0, 1, 2, ... in file order: files by path, rows as they stand.

    Call this on a scan: its split into blocks is fixed by the files, so the counts of the first pass still hold in the
    second.  Blocks are ordered by file and offset, as Spark deals them out by size.  What is joined is one row per block;
    nothing reaches the driver.
    """
    source = ["_metadata.file_path", "_metadata.file_block_start"]
    placed = df.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.col(source[0]).alias("_file"),
        F.col(source[1]).alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    place = ["_part", "_file", "_block"]
    blocks = placed.groupBy(*place).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    # Two levels of running sums: over one row per file, and over the blocks of each file.
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("_file").agg(F.sum("_n").alias("_n")).select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_inside", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(files, "_file")
    offsets = starts.select(*place, (F.col("_before") + F.col("_inside") - F.col("_first")).alias("_start"))
    return placed.join(offsets, ["_part", "_file", "_block"]).select(
        (quoted("_start") + quoted("_at")).alias(row_id), *[quoted(c) for c in df.columns]
    )
