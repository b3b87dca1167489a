"""Calendar expressions. Weekdays follow Spark: 1 = Sunday ... 7 = Saturday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekend_flag(day: Column) -> Column:
    """1.0 on Saturday and Sunday, else 0.0 (a model feature, hence double)."""
    return F.when(F.dayofweek(day).isin(1, 7), F.lit(1.0)).otherwise(F.lit(0.0))


def calendar_parts(ts: Column) -> dict[str, Column]:
    """The calendar features of an hourly series."""
    return {
        "hour": F.hour(ts),
        "dayofweek": F.dayofweek(ts),
        "month": F.month(ts),
        "is_weekend": weekend_flag(ts),
    }


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 (bigint); zone-free for TIMESTAMP_NTZ."""
    return F.unix_timestamp(ts)
