"""Lower median of an ordinal, from a histogram.

An ordinal has few distinct values, so its histogram is a plain hash aggregate with a map-side
combine. The quantile aggregates keep an object per group and fall back to sorting all rows
when there are many groups; this form never sorts rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def aggregate_with_median(
    histogram: DataFrame,
    keys: Sequence[str],
    ordinal: str,
    size: str,
    measures: Sequence[Column],
    name: str,
) -> DataFrame:
    """Roll histogram rows (keys, ordinal, size) up to the keys, with the median ordinal.

    The median is the least ordinal that at least half of the known answers do not exceed;
    it is NULL where no answer is known.
    """
    group = Window.partitionBy(*keys)
    up_to_here = group.orderBy(F.asc_nulls_first(ordinal)).rowsBetween(Window.unboundedPreceding, 0)
    weight = F.when(F.col(ordinal).isNotNull(), F.col(size)).otherwise(0)
    reached = histogram.withColumns(
        {"_below": F.sum(weight).over(up_to_here), "_all": F.sum(weight).over(group)}
    )
    at_half = F.when(F.col("_below") * 2 >= F.col("_all"), F.col(ordinal))
    return reached.groupBy(*keys).agg(*measures, F.min(at_half).cast("int").alias(name))
