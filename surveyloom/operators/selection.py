"""Row selection: eligibility, small-cell suppression and ordered categories."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def known(frame: DataFrame, *columns: str) -> DataFrame:
    """Rows where all the columns have a value."""
    return frame.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def in_segment(frame: DataFrame, label: str, kind: str = "segmento_tipo") -> DataFrame:
    """The cells of one segmentation."""
    return frame.filter(F.col(kind) == label)


def ascending(name: str) -> Column:
    return F.asc_nulls_last(name)


def descending(name: str) -> Column:
    return F.desc_nulls_last(name)


def suppress_small(frame: DataFrame, size: str, minimum: int) -> DataFrame:
    """Cells with at least ``minimum`` answers behind the metric that is shown."""
    return frame.filter(F.col(size) >= minimum)


def display_rank(column: str, order: Sequence[str]) -> Column:
    """Position in the preferred order; every other category comes after."""
    position = F.array_position(F.array(*[F.lit(item) for item in order]), F.col(column))
    return F.when(position > 0, position).otherwise(len(order) + 1).cast("int")


def keep_ordered(frame: DataFrame, column: str, order: Sequence[str], rank: str = "ordem") -> DataFrame:
    """Only the listed categories, with their position."""
    return frame.filter(F.col(column).isin(*order)).withColumn(rank, display_rank(column, order))


def has_columns(frame: DataFrame | None, columns: Iterable[str]) -> bool:
    return frame is not None and set(columns) <= set(frame.columns)


def distinct_years(frame: DataFrame, year: str = "ano_pesquisa") -> DataFrame:
    """The years present, ascending: the ticks of a time axis."""
    return known(frame.select(year), year).distinct().orderBy(year)
