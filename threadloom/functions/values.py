"""Flags, time bounds and exact decimal ratios."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Epoch seconds outside this inclusive range are not believable.
MIN_EPOCH = 1100000000
MAX_EPOCH = 1800000000


def flag(value: Column, dtype: T.DataType) -> Column:
    """Turn a stored flag into a boolean; a missing value is false.

    Numbers are true when something is left after truncation, text when it is
    not empty.
    """
    if isinstance(dtype, T.BooleanType):
        truth = value
    elif isinstance(dtype, T.StringType):
        truth = value != ""
    elif isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        number = value.cast("double")
        truth = ~F.isnan(number) & (F.abs(number) >= 1)
    else:
        truth = value != 0
    return F.coalesce(truth, F.lit(False))


def as_int(value: Column) -> Column:
    """Boolean to 0 or 1; a missing value is 0."""
    return F.coalesce(value, F.lit(False)).cast("int")


def unbelievable_time(epoch: Column) -> Column:
    """The time is present and outside the accepted range; never NULL."""
    return F.coalesce(~epoch.between(MIN_EPOCH, MAX_EPOCH), F.lit(False))


def epoch(text: str) -> int:
    """Epoch seconds of a UTC date or date-time, so that filters stay on the raw long column."""
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def rounded_ratio(total: Column, count: Column, digits: int = 2) -> Column:
    """total / count of non-negative whole numbers, rounded half up.

    Whole-number arithmetic keeps ties exact, as an average over decimals does;
    an average over doubles need not.
    """
    scale = 10**digits
    scaled = F.call_function(
        "div", total * F.lit(2 * scale) + count, F.nullif(count * F.lit(2), F.lit(0))
    )
    return scaled / F.lit(float(scale))
