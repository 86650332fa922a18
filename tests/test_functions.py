import pytest
from pyspark.sql import functions as F

from surveyloom.functions import (
    coerce_numbers,
    mentions,
    money_label,
    percent,
    percent_label,
    pt_count,
    pt_number,
    quoted,
    to_number,
    weighted_mean,
)


@pytest.mark.parametrize(
    ("part", "whole", "share"),
    [(1, 3, 33.33), (2, 3, 66.67), (0, 5, 0.0), (1, 0, None), (1, None, None), (None, 4, None), (1, -2, None)],
)
def test_percent_needs_an_eligible_denominator(spark, part, whole, share):
    frame = spark.createDataFrame([(part, whole)], "part int, whole int")
    assert frame.select(percent("part", "whole")).first()[0] == share


def test_percent_rounds_half_away_from_zero(spark):
    frame = spark.createDataFrame([(1, 800)], "part int, whole int")
    assert frame.select(percent("part", "whole")).first()[0] == 0.13


def test_mentions_take_unanswered_as_zero(spark):
    frame = spark.createDataFrame([(1,), (0,), (None,), (1,)], "flag int")
    assert frame.agg(mentions("flag")).first()[0] == 2
    unanswered = spark.createDataFrame([(None,), (None,)], "flag int")
    assert unanswered.agg(mentions("flag"), F.count("flag"), F.sum("flag")).first()[:] == (0, 0, None)


def test_weighted_mean_without_weight_is_null(spark):
    frame = spark.createDataFrame([(10.0, 3), (20.0, 1), (None, 0)], "value double, weight int")
    assert frame.agg(weighted_mean("value", "weight")).first()[0] == 12.5
    assert frame.filter("weight = 0").agg(weighted_mean("value", "weight")).first()[0] is None


@pytest.mark.parametrize(
    ("value", "text"),
    [
        (523.0, "523,0"),
        (1234.0, "1.234,0"),
        (1234567.0, "1.234.567,0"),
        (12.65, "12,7"),
        (12.25, "12,2"),
        (-3.25, "-3,2"),
        (0.05, "0,1"),
    ],
)
def test_pt_number(spark, value, text):
    assert spark.range(1).select(pt_number(F.lit(value))).first()[0] == text


def test_label_text(spark):
    row = spark.range(1).select(
        pt_count(F.lit(1234567)), percent_label(F.lit(45.25)), money_label(F.lit(12345.0)), money_label(F.lit(None))
    ).first()
    assert row[:] == ("1.234.567", "45,2%", "R$ 12,3 mil", None)


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("1", 1.0),
        (" 2 ", 2.0),
        ("1e3", 1000.0),
        ("-.5", -0.5),
        ("+3.", 3.0),
        ("inf", float("inf")),
        ("x", None),
        ("", None),
        (None, None),
        ("1,5", None),
        ("1_0", None),
        ("1d", None),
        ("0x10", None),
        ("nan", None),
    ],
)
def test_to_number(spark, text, number):
    frame = spark.createDataFrame([(text,)], "text string")
    assert frame.select(to_number(F.col("text"))).first()[0] == number


def test_coerce_numbers_leaves_numbers_and_absent_columns(spark):
    frame = spark.createDataFrame([("7", 3, "a")], "`a.b` string, n int, t string")
    result = coerce_numbers(frame, ["a.b", "n", "missing"])
    assert result.dtypes == [("a.b", "double"), ("n", "int"), ("t", "string")]
    assert result.first()[:] == (7.0, 3, "a")


def test_quoted_names(spark):
    frame = spark.createDataFrame([(1, 2, 3)], ["a.b", "c `d`", "e f"])
    assert frame.select(quoted("a.b"), quoted("c `d`"), quoted("e f")).first()[:] == (1, 2, 3)
