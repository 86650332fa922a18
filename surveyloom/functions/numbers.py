"""Text to numbers, with unreadable text as NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions.columns import quoted

# A plain cast also takes type suffixes ("1d") and hexadecimal floats, which are not numbers here.
READABLE = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def to_number(text: Column) -> Column:
    return F.when(text.rlike(READABLE), text.try_cast("double"))


def whole_number(text: Column) -> Column:
    """Text to a whole number, exactly: digits of any length that fit, or a number without a fraction (`1.0`, `1e3`)."""
    number = to_number(text)
    exact = (number == F.floor(number)) & (F.abs(number) < 2.0**53)
    return F.coalesce(text.try_cast("bigint"), F.when(exact, number.try_cast("bigint")))


def coerce_numbers(frame: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn the text columns among those named into doubles; names the frame lacks are ignored."""
    texts = [
        name
        for name in columns
        if name in frame.columns and isinstance(frame.schema[name].dataType, T.StringType)
    ]
    return frame.withColumns({name: to_number(quoted(name)) for name in texts}) if texts else frame
