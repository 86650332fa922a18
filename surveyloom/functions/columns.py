"""Column references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column with exactly this name, whatever dots, spaces or backticks it has."""
    escaped = name.replace("`", "``")
    return F.col(f"`{escaped}`")
