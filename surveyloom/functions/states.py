"""What the aggregate tables measure, from rows or from cells that already hold partial results.

A cell holds sums and counts only, which can be added further, so any grouping of cells gives what the same grouping of the rows behind
them gives. Means and shares are taken last.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sum(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


class Rows:
    """Measures of row-level columns."""

    def inputs(self, *columns: str) -> list[str]:
        """The columns that measures of `columns` read."""
        return list(columns)

    def size(self) -> Column:
        return F.count("*")

    def answered(self, column: str) -> Column:
        """Rows that were asked and answered."""
        return F.count(column)

    def hits(self, column: str, value: str | int = 1) -> Column:
        """Rows with this answer."""
        return F.count_if(F.col(column) == value)

    def total(self, column: str) -> Column:
        """Sum of the known values; NULL if none is known."""
        return F.sum(column)

    def mentions(self, flag: str, among: str | None = None) -> Column:
        """Rows whose flag is set; an unanswered flag adds nothing. `among` restricts them to rows that answered that column."""
        value = F.coalesce(F.col(flag), F.lit(0))
        return _sum(value if among is None else F.when(F.col(among).isNotNull(), value)).cast("long")

    def answering(self, frame: DataFrame, column: str) -> DataFrame:
        """What has an answer in `column`."""
        return frame.filter(F.col(column).isNotNull())

    def mean(self, column: str) -> Column:
        """Mean of the known values, to two places; NULL if none is known."""
        return F.round(self.total(column) / F.nullif(self.answered(column), F.lit(0)), 2)


class Cells(Rows):
    """The same measures of cells, as `cells` builds them."""

    def __init__(self, dimensions: Sequence[str], flags: Mapping[str, str | None], amounts: Sequence[str]) -> None:
        self.dimensions, self.flags, self.amounts = tuple(dimensions), dict(flags), tuple(amounts)

    def build(self, frame: DataFrame) -> DataFrame:
        """One row per combination of the dimensions. flags: flag -> the column among whose answers it is counted (None: all rows)."""
        rows = Rows()
        states = [rows.size().alias("n")]
        for flag, among in self.flags.items():
            states += [F.count(flag).alias(f"n_{flag}"), rows.mentions(flag, among).alias(f"hits_{flag}")]
        for amount in self.amounts:
            states += [F.count(amount).alias(f"n_{amount}"), F.sum(amount).alias(f"sum_{amount}")]
        return frame.groupBy(*self.dimensions).agg(*states)

    def inputs(self, *columns: str) -> list[str]:
        states = ["n"]
        for column in columns:
            if column in self.flags:
                states += [f"n_{column}", f"hits_{column}"]
            elif column in self.amounts:
                states += [f"n_{column}", f"sum_{column}"]
            else:
                states.append(column)
        return states

    def size(self) -> Column:
        return _sum(F.col("n"))

    def answered(self, column: str) -> Column:
        known = F.when(F.col(column).isNotNull(), F.col("n")) if column in self.dimensions else F.col(f"n_{column}")
        return _sum(known)

    def hits(self, column: str, value: str | int = 1) -> Column:
        if column in self.dimensions:
            return _sum(F.when(F.col(column) == value, F.col("n")))
        if value != 1:
            raise ValueError(f"cells count where {column} is 1, not {value}")
        return _sum(F.col(f"hits_{column}"))

    def total(self, column: str) -> Column:
        return F.sum(f"sum_{column}" if column in self.amounts else f"hits_{column}")

    def mentions(self, flag: str, among: str | None = None) -> Column:
        if self.flags[flag] != among:
            raise ValueError(f"cells count {flag} among the answers of {self.flags[flag]}, not of {among}")
        return _sum(F.col(f"hits_{flag}"))

    def answering(self, frame: DataFrame, column: str) -> DataFrame:
        """Cells some of whose rows answered a flag: their other rows count for nothing in what is measured among the answers."""
        return frame.filter(F.col(column).isNotNull() if column in self.dimensions else F.col(f"n_{column}") > 0)


ROWS = Rows()
