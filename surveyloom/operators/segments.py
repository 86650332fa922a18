"""The same measures for several alternative segmentations, in one pass over the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.vocabulary import EVERYONE

Segments = Mapping[str, str | None]


def stack_segments(
    frame: DataFrame,
    segments: Segments,
    carry: Sequence[str],
    type_name: str,
    value_name: str,
) -> DataFrame:
    """One row per (row, segment the row belongs to).

    Catalyst plans this as a single Expand over a single scan, and one segment as a projection. A row without a value in a
    segment does not belong to it and goes before it reaches any aggregate.
    """
    clash = set(segments) & set(carry)
    if clash:
        raise ValueError(f"Segment labels equal carried columns: {sorted(clash)}")
    values = [
        (F.lit(EVERYONE) if column is None else F.col(column)).alias(label)
        for label, column in segments.items()
    ]
    if len(segments) == 1:
        label = next(iter(segments))
        stacked = frame.select(*carry, F.lit(label).alias(type_name), values[0].alias(value_name))
    else:
        stacked = frame.select(*carry, *values).unpivot(list(carry), list(segments), type_name, value_name)
    return stacked.filter(F.col(value_name).isNotNull())


def segment_aggregate(
    frame: DataFrame,
    segments: Segments,
    keys: Sequence[str],
    inputs: Sequence[str],
    measures: Sequence[Column],
    type_name: str = "segmento_tipo",
    value_name: str = "segmento_valor",
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Aggregate ``measures`` by keys and segment; ``inputs`` are the columns they read."""
    carry = [*keys, *inputs]
    stacked = stack_segments(frame, segments, carry, type_name, value_name)
    return stacked.groupBy(*keys, type_name, value_name, *extra_keys).agg(*measures)


def unpivot_flags(frame: DataFrame, flags: Mapping[str, str], ids: Sequence[str], label: str, value: str) -> DataFrame:
    """One row per (row, flag). Unanswered flags stay as NULL rows, for the denominators."""
    wide = frame.select(*ids, *[F.col(column).alias(name) for name, column in flags.items()])
    return wide.unpivot(list(ids), list(flags), label, value)
