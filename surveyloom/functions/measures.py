"""Aggregates over 0/1/NULL flags and ratios with an eligible denominator.

NULL means "not asked", so the denominator of every share is the count of non-null answers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def answered(column: str) -> Column:
    """Rows that were asked and answered."""
    return F.count(column)


def mentions(flag: str) -> Column:
    """Rows whose flag is set; an unanswered flag adds nothing."""
    return F.sum(F.coalesce(F.col(flag), F.lit(0))).cast("long")


def mean_2dp(column: str) -> Column:
    """Mean of the known values, to two places."""
    return F.round(F.avg(column), 2)


def percent(part: str, whole: str) -> Column:
    """part / whole in percent, to two places; NULL where nobody was eligible."""
    share = F.col(part) / F.col(whole) * 100
    return F.when(F.col(whole) > 0, F.round(share, 2))


def weighted_mean(value: str, weight: str) -> Column:
    """Mean of cell means, each weighted by the rows behind it."""
    total = F.nullif(F.sum(weight), F.lit(0))
    return F.sum(F.col(value) * F.col(weight)) / total
