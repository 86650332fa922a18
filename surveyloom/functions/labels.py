"""Number text in Brazilian Portuguese: dot for thousands, comma for decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pt_number(value: Column, decimals: int = 1) -> Column:
    return F.translate(F.format_number(value, decimals), ",.", ".,")


def pt_count(value: Column) -> Column:
    return pt_number(value, 0)


def percent_label(value: Column) -> Column:
    return F.concat(pt_number(value), F.lit("%"))


def money_label(value: Column) -> Column:
    """An amount in thousands, such as ``R$ 12,3 mil``."""
    return F.concat(F.lit("R$ "), pt_number(value / 1000), F.lit(" mil"))
