"""Totals attached to aggregate cells, and shares of them.

Totals are taken from the cells, never again from the rows: the cells' shuffle is reused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions import percent


def join_total(cells: DataFrame, by: Sequence[str], measure: str, name: str) -> DataFrame:
    """Inner join with the total per key: a cell with a NULL key has no total and goes.

    No broadcast hint: adaptive execution broadcasts the totals once it has measured them.
    """
    totals = cells.groupBy(*by).agg(F.sum(measure).alias(name))
    return cells.join(totals, list(by))


def window_total(measure: str, by: Sequence[str]) -> Column:
    """Total over all cells of a partition; NULL keys form a partition of their own."""
    return F.sum(measure).over(Window.partitionBy(*by))


def with_share(cells: DataFrame, measure: str, total: str, share: str) -> DataFrame:
    return cells.withColumn(share, percent(measure, total))
