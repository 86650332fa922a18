"""Latest-edition and top-k selection over aggregate cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_row(frame: DataFrame, year: str = "ano_pesquisa") -> DataFrame:
    """The one row of the greatest year; none if there are no rows."""
    newest = frame.agg(F.max_by(F.struct("*"), F.col(year)).alias("row"))
    return newest.filter(F.col("row").isNotNull()).select("row.*")


def latest_cells(cells: DataFrame, measure: str, year: str = "ano_pesquisa") -> DataFrame:
    """All cells of the greatest year.

    The one-row maximum is joined back and not used as a filter: a filter would be pushed into
    the scan, and the rows would be read once for the maximum and again for the cells. The
    maximum carries ``measure`` along, so that both sides keep the same columns and share a shuffle.
    """
    newest = cells.agg(F.max(F.struct(year, measure)).alias("newest"))
    return cells.join(newest.select(F.col(f"newest.{year}").alias(year)), year)


def top_k(cells: DataFrame, measure: str, name: str, k: int) -> DataFrame:
    """The k greatest cells, smallest first for display; equal cells in name order."""
    best = cells.orderBy(F.desc_nulls_last(measure), F.asc_nulls_last(name)).limit(k)
    return best.orderBy(F.asc_nulls_last(measure), F.desc_nulls_last(name))
