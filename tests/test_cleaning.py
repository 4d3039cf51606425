"""Typing, recoding, derived features and bands, with worked answers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weighted_insights import survey
from weighted_insights.functions import cleaning as C
from weighted_insights.functions import features as X
from weighted_insights.operators import profiles as P
from weighted_insights.sources import reader

RAW = ["age", "own business or self employed", "detailed industry recode", "year", "weight", "label"]


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in RAW))


def test_clean_codes_numbers_label_and_weight(spark):
    raw = raw_rows(
        spark,
        [
            ("42", "1", "12", "94", "10.5", "- 50000."),
            ("x", "2", "0", "95", None, "50000+."),
            ("NA", "0", "NA", "96", "bad", "- 50000."),
            ("1d", "3", "7", "NA", "3", "50000+."),
        ],
    )
    rows = C.label_and_weight(C.clean(C.drop_missing_tokens(raw))).collect()
    assert [tuple(r) for r in rows] == [
        (42.0, "Yes", "12", "1994", 0, 10.5),
        (None, "No", "NIU", "1995", 1, 0.0),
        (None, "NIU", "NIU", None, 0, 0.0),
        (None, "NIU", "7", None, 1, 3.0),
    ]


@pytest.mark.parametrize("label", ["other", " - 50000.", None])
def test_unknown_label_fails(spark, label):
    rows = C.label_and_weight(raw_rows(spark, [("5", "NA", "1", "94", "1", label)]))
    with pytest.raises(Exception, match="unknown label"):
        rows.collect()


def test_numbers_in_text(spark):
    texts = ["1", " 2.5 ", "-3e2", "1d", "2f", "0x1p3", "NaN", "", "1,000", ".5", "7.", "+4", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(C.text_to_double(F.col("t"))).collect()
    assert [r[0] for r in rows] == [1, 2.5, -300, None, None, None, None, None, None, 0.5, 7, 4, None]


def test_codes_must_be_integral(spark):
    rows = spark.createDataFrame([("1.0",), ("1.5",), ("12",)], "t string")
    assert [r[0] for r in rows.select(C.to_code(C.text_to_double(F.col("t")))).collect()] == [1, None, 12]


def test_missing_tokens_are_not_trimmed(spark):
    rows = spark.createDataFrame([("NA",), (" NA",), ("?",), ("",), ("null",), ("NIU",)], "t string")
    assert [r[0] for r in C.drop_missing_tokens(rows).collect()] == [None, " NA", "?", None, None, "NIU"]


def test_nan_in_a_numeric_column_is_missing(spark):
    rows = spark.createDataFrame([(float("nan"),), (2.0,)], "age double")
    assert [r.age for r in C.clean(rows).collect()] == [None, 2.0]


def test_absent_columns_are_skipped(spark):
    rows = spark.createDataFrame([("a", 1)], "other string, n int")
    assert C.clean(rows).collect() == rows.collect()
    assert X.add_bands(X.derive(rows)).columns == ["other", "n"]


def test_derived_features(spark):
    columns = "`wage per hour` double, `capital gains` double, `capital losses` double, `dividends from stocks` double, "
    columns += "`weeks worked in year` double, education string, `enroll in edu inst last wk` string"
    rows = spark.createDataFrame(
        [
            (0.0, 100.0, 0.0, 5.0, 52.0, "Children", "High school"),
            (None, 0.0, 50.0, None, None, "10th grade", None),
            (7.0, None, None, None, 0.0, "unknown", "Not in universe"),
        ],
        columns,
    )
    wanted = ["has_wage", "invest_income", "has_invest_income", "worked_any_weeks", "full_year_52w", "is_student"]
    made = X.derive(rows)
    assert [tuple(r) for r in made.select(*wanted, "education_ord").collect()] == [
        (False, 105.0, True, True, True, True, 0),
        (False, -50.0, False, False, False, False, 6),
        (True, 0.0, False, False, False, False, None),
    ]
    assert P.new_columns(rows, made) == sorted([*wanted, "education_ord"])
    assert P.type_counts(made)["boolean"] == 5


def test_partial_investment_columns_give_no_income(spark):
    rows = spark.createDataFrame([(1.0,)], "`capital gains` double")
    assert "invest_income" not in X.derive(rows).columns


def test_bands_are_closed_on_the_right(spark):
    rows = spark.createDataFrame(
        [(17.0, 0.0), (18.0, 1.0), (24.0, 13.0), (25.0, 14.0), (64.0, 47.0), (65.0, 48.0), (None, None)],
        "age double, `weeks worked in year` double",
    )
    made = X.add_bands(rows)
    assert [r.age_band for r in made.collect()] == ["<18", "18-24", "18-24", "25-34", "55-64", "65+", None]
    assert [r.weeks_band for r in made.collect()] == ["0", "1-13", "1-13", "14-26", "40-47", "48-52+", None]


def test_clip_keeps_missing(spark):
    rows = spark.createDataFrame([(-1.0,), (2.0,), (None,)], "x double")
    assert [r[0] for r in rows.select(X.clip_at_zero(F.col("x"))).collect()] == [0.0, 2.0, None]


def test_read_survey_names_quotes_and_short_rows(spark, tmp_path):
    names_file, data_file = tmp_path / "names", tmp_path / "data"
    names_file.write_text("a\n\n b b \nc's\n")
    data_file.write_text('1,"x, ""y""",NA\n2, NA\n3,?,z\n')
    names = reader.read_column_names(spark, str(names_file))
    assert names == ["a", "b b", "c's"]
    rows = reader.read_survey(spark, str(data_file), names)
    assert [tuple(r) for r in rows.collect()] == [("1", 'x, "y"', None), ("2", " NA", None), ("3", "?", "z")]
    assert dict(reader.read_survey(spark, str(data_file), names, infer_types=True).dtypes)["a"] == "int"


def test_row_ids_are_contiguous_over_partitions(spark, tmp_path):
    spark.range(0, 1000, 1, 7).write.parquet(str(tmp_path / "t"))
    rows = reader.with_row_id(spark.read.parquet(str(tmp_path / "t")))
    assert sorted(r.row_id for r in rows.collect()) == list(range(1000))


def test_the_survey_has_42_columns_and_36_segment_features():
    assert len(survey.SURVEY_COLUMNS) == len(set(survey.SURVEY_COLUMNS)) == 42
    assert len(survey.SEGMENT_NUMERIC) + len(survey.SEGMENT_CATEGORICAL) == 36
    assert len(survey.PROFILE_TOP_CATEGORIES) == 35
    assert len(survey.PROFILE_CROSSTABS) == 15
    assert len(survey.EDUCATION_LEVELS) == 17


def test_row_ids_follow_the_files(spark, tmp_path):
    """A small first file, which Spark deals out last."""
    (tmp_path / "part-0.csv").write_text("a\nb\n")
    (tmp_path / "part-1.csv").write_text("".join(f"r{i}\n" for i in range(2000)))
    rows = reader.with_row_id(reader.read_survey(spark, str(tmp_path), ["v"]))
    assert [r.v for r in rows.orderBy("row_id").limit(4).collect()] == ["a", "b", "r0", "r1"]
    assert rows.agg(F.max("row_id")).first()[0] == 2001


def test_missing_tokens_do_not_hide_numbers(spark, tmp_path):
    (tmp_path / "t.csv").write_text("NaN,1.5,x,NA,7d\nnull,,2,n/a,8\n3,2,3,#N/A,9\n")
    rows = reader.read_survey(spark, str(tmp_path / "t.csv"), list("abcde"), infer_types=True)
    assert dict(rows.dtypes) == {"a": "int", "b": "double", "c": "string", "d": "int", "e": "string"}
    assert [r.a for r in rows.collect()] == [None, None, 3]


def test_row_ids_over_many_files_and_blocks(spark, tmp_path):
    import random

    draw, lines = random.Random(4), []
    for f in range(9):
        some = [f"f{f}r{i}" for i in range(draw.choice([0, 1, 3, 4000]))]
        (tmp_path / f"part-{f}.csv").write_text("".join(line + "\n" for line in some))
        lines += some
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = reader.with_row_id(reader.read_survey(spark, str(tmp_path), ["v"]))
        assert [r.v for r in rows.orderBy("row_id").collect()] == lines
        assert sorted(r.row_id for r in rows.collect()) == list(range(len(lines)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_assignments_are_written_in_order(spark, tmp_path):
    from weighted_insights.sources import writer

    rows = spark.range(0, 5000, 1, 7).select((4999 - F.col("id")).alias("n"), (F.col("id") % 6).alias("s")).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writer.write_assignments(rows, str(tmp_path / "a"), "n", "s", 6)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [p.read_text().splitlines() for p in sorted((tmp_path / "a").glob("part-*.csv"))]
    assert len(parts) > 2 and all(p[0] == "row_id,segment_kmeans_6" for p in parts)
    assert [int(line.split(",")[0]) for p in parts for line in p[1:]] == list(range(5000))
