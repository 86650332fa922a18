from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.operators.duplicates import duplicate_profile, repeated_rows
from surveyloom.operators.matrix import pivot_mean, pivot_sum
from surveyloom.operators.median import aggregate_with_median
from surveyloom.operators.ranking import latest_cells, latest_row, top_k
from surveyloom.operators.segments import segment_aggregate, stack_segments, unpivot_flags
from surveyloom.operators.selection import display_rank, distinct_years, keep_ordered, suppress_small
from surveyloom.operators.totals import join_total, window_total
from surveyloom.vocabulary import PAY_SEGMENTS, TECHNOLOGIES


def test_unpivot_keeps_null_answers(spark, rows):
    frame = spark.createDataFrame([(1, 1, None), (2, None, 0)], "id int, a int, b int")
    long = unpivot_flags(frame, {"A": "a", "B": "b"}, ["id"], "label", "answer")
    assert rows(long) == [(1, "A", 1), (1, "B", None), (2, "A", None), (2, "B", 0)]


def test_segments_equal_the_union_of_separate_aggregates(silver, rows):
    measures = [F.count("*").alias("n"), F.count("salario_ponto_medio").alias("m")]
    one_pass = segment_aggregate(
        silver, PAY_SEGMENTS, ["ano_pesquisa"], ["salario_ponto_medio"], measures, "tipo", "valor"
    )
    separate = [
        silver.filter(F.col(column).isNotNull())
        .groupBy("ano_pesquisa", F.lit(label).alias("tipo"), F.col(column).alias("valor"))
        .agg(*measures)
        for label, column in PAY_SEGMENTS.items()
    ]
    assert rows(one_pass) == rows(reduce(DataFrame.unionByName, separate))


def test_a_row_without_segment_value_is_in_no_segment(spark, rows):
    frame = spark.createDataFrame([(1, "x"), (1, None)], "y int, s string")
    stacked = stack_segments(frame, {"geral": None, "seg": "s"}, ["y"], "tipo", "valor")
    assert rows(stacked) == [(1, "geral", "Todos"), (1, "geral", "Todos"), (1, "seg", "x")]


def test_segment_labels_must_differ_from_carried_columns(spark):
    frame = spark.createDataFrame([(1, "x")], "y int, s string")
    with pytest.raises(ValueError, match="Segment labels"):
        stack_segments(frame, {"y": "s"}, ["y"], "tipo", "valor")


@pytest.mark.parametrize(
    ("ordinals", "median"),
    [([1, 2, 3], 2), ([1, 2], 1), ([5], 5), ([1, 1, 1, 5, 5], 1), ([None, 2, 4, 4], 4), ([None, None], None)],
)
def test_lower_median(spark, ordinals, median):
    frame = spark.createDataFrame([("k", o) for o in ordinals], "k string, o int")
    histogram = frame.groupBy("k", "o").agg(F.count("*").alias("n"))
    result = aggregate_with_median(histogram, ["k"], "o", "n", [F.sum("n").alias("n")], "median").first()
    assert (result.median, result.n) == (median, len(ordinals))
    assert frame.agg(F.percentile_approx("o", 0.5)).first()[0] == median


def test_lower_median_matches_the_sketch_on_survey_rows(silver, rows):
    histogram = silver.groupBy("regiao_moradia", "salario_ordem").agg(F.count("*").alias("n"))
    exact = aggregate_with_median(histogram, ["regiao_moradia"], "salario_ordem", "n", [], "m")
    sketch = silver.groupBy("regiao_moradia").agg(F.percentile_approx("salario_ordem", 0.5).alias("m"))
    assert rows(exact) == rows(sketch)


def test_totals_join_drops_and_window_keeps_null_keys(spark, rows):
    cells = spark.createDataFrame([(1, 2), (1, 3), (None, 4)], "k int, n bigint")
    assert rows(join_total(cells, ["k"], "n", "total")) == [(1, 2, 5), (1, 3, 5)]
    windowed = cells.withColumn("total", window_total("n", ["k"]))
    assert rows(windowed) == [(1, 2, 5), (1, 3, 5), (None, 4, 4)]


def test_pivots_fill_sums_and_leave_means(spark, rows):
    cells = spark.createDataFrame([(1, "a", 2), (1, "a", 4), (2, "b", 5), (2, "z", 9)], "y int, c string, n int")
    assert rows(pivot_sum(cells, "y", "c", ["a", "b"], "n")) == [(1, 6, 0), (2, 0, 5)]
    assert rows(pivot_mean(cells, "y", "c", ["a", "b"], "n")) == [(1, 3.0, None), (2, None, 5.0)]


def test_top_k_breaks_ties_by_name_and_displays_ascending(spark):
    cells = spark.createDataFrame([(n, i % 4) for i, n in enumerate("hgfedcba")], "name string, v int")
    best = [(r.name, r.v) for r in top_k(cells, "v", "name", 3).collect()]
    assert best == [("b", 2), ("e", 3), ("a", 3)]


def test_latest(spark, rows):
    cells = spark.createDataFrame([(1, "a", 5), (3, "b", 6), (3, "c", 7), (4, "d", 0)], "y int, t string, n int")
    assert rows(latest_cells(cells, "n", "y")) == [(4, "d", 0)]
    assert latest_row(cells, "y").first()[:] == (4, "d", 0)


def test_ordered_categories(spark, rows):
    frame = spark.createDataFrame([("b",), ("a",), ("z",), (None,)], "c string")
    assert rows(keep_ordered(frame, "c", ["b", "a"])) == [("a", 2), ("b", 1)]
    ranks = frame.withColumn("r", display_rank("c", ["b", "a"]))
    assert rows(ranks) == [("a", 2), ("b", 1), ("z", 3), (None, 3)]


def test_suppression_uses_the_given_size(spark, rows):
    frame = spark.createDataFrame([(29,), (30,), (None,)], "n int")
    assert rows(suppress_small(frame, "n", 30)) == [(30,)]


def test_distinct_years_are_sorted_without_null(spark):
    frame = spark.createDataFrame([(2002,), (None,), (2001,), (2002,)], "ano_pesquisa int")
    assert [r[0] for r in distinct_years(frame).collect()] == [2001, 2002]


PLANTED = [("a", None), (None, "a"), ("b", "b"), ("b", "b"), ("c", None), ("c", None), ("c", None), ("d", "d")]


def test_duplicates_with_null_shifted_rows(spark, rows):
    frame = spark.createDataFrame(PLANTED, "x string, y string")
    assert duplicate_profile(frame).first()[:] == (8, 3)
    assert rows(repeated_rows(frame)) == [("b", "b", 2), ("c", None, 3)]


@pytest.mark.parametrize("width", [0, 12, 13, 400])
def test_the_identity_does_not_depend_on_the_width(spark, width):
    """4 + width columns: microseconds, signed zeros, NaN and bytes count alike, however many columns there are."""
    rows = [
        ("2024-01-01 00:00:00.000001", 0.0, b"a"), ("2024-01-01 00:00:00.000002", 0.0, b"a"), ("2024-01-01 00:00:00.000001", -0.0, b"a"),
        ("2024-01-01 00:00:00.000001", float("nan"), b"b"), ("2024-01-01 00:00:00.000001", float("nan"), b"b"), (None, None, None), (None, None, b""),
    ]
    frame = spark.createDataFrame(rows, "t string, x double, b binary").selectExpr(
        "CAST(t AS timestamp) AS t", "CAST(t AS timestamp_ntz) AS u", "x", "b", *[f"CAST(NULL AS string) AS `p.{i}`" for i in range(width)]
    )
    assert duplicate_profile(frame).first()[:] == (7, 2)


def test_duplicates_of_one_hot_row_and_of_no_rows(spark):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"))
    assert duplicate_profile(hot).first()[:] == (30_000, 9_999)
    assert duplicate_profile(hot.limit(0)).first()[:] == (0, 0)


def test_technologies_are_eight():
    assert len(TECHNOLOGIES) == 8
