"""Cross tables and the shares, stacks and thresholds drawn from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.operators.totals import window_total


def pivot_sum(cells: DataFrame, index: str, column: str, values: Sequence[str], measure: str) -> DataFrame:
    """Sum per index x category; a missing combination is 0."""
    return cells.groupBy(index).pivot(column, list(values)).agg(F.sum(measure)).na.fill(0, list(values))


def pivot_mean(cells: DataFrame, index: str, column: str, values: Sequence[str], measure: str) -> DataFrame:
    """Mean per index x category; a missing combination stays NULL."""
    return cells.groupBy(index).pivot(column, list(values)).agg(F.avg(measure))


def row_share(measure: str, index: str) -> Column:
    """Share of the index row's total, in percent; NULL if the total is 0."""
    return F.col(measure) / F.nullif(window_total(measure, [index]), F.lit(0)) * 100


def total_before(measure: str, index: str, order: Sequence[str]) -> Column:
    """Sum over the categories drawn below this one."""
    below = Window.partitionBy(index).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(measure).over(below), F.lit(0))


def above_median(cells: DataFrame, measure: str) -> Column:
    """Whether a cell exceeds the median of all known cells.

    A scalar subquery over the same cells, so their shuffle is reused.
    """
    return F.col(measure) > cells.agg(F.median(measure)).scalar()
