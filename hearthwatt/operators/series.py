"""Hourly series per home and the features a forecast is made from.

Window functions need all rows of a home in one task. They therefore belong after
``hourly_rollup``: there a home has at most one row per hour, however many
readings it sent, so even a home with a third of all readings stays small (about
8,800 rows a year).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ..functions import calendar_parts, epoch_seconds, missing

HOUR_SECONDS = 3600

# Working measure -> name in the hourly series.
HOURLY_MEASURES = {
    "energy_consumption": "consumption",
    "outdoor_temperature": "outdoor_temp",
    "household_size": "household_size",
}

LABEL = "consumption"

# The ten model inputs.
FEATURES = (
    "lag_1",
    "lag_24",
    "rolling_mean_24",
    "rolling_std_24",
    "outdoor_temp",
    "household_size",
    "hour",
    "dayofweek",
    "month",
    "is_weekend",
)

# The columns whose NULLs end a row's use as a training example.
REQUIRED = ("consumption", "lag_1", "lag_24", "rolling_mean_24")


def hourly_rollup(
    df: DataFrame,
    measures: Mapping[str, str] = HOURLY_MEASURES,
    key: str = "home_id",
    ts: str = "ts",
    width: str = "60 minutes",
    count_as: str | None = None,
) -> DataFrame:
    """Mean of each measure per home and tumbling time window; ``ts`` is its start.

    Grouping by home and window lets every task reduce its own readings before the
    shuffle and spreads one busy home over many reducers. A finer ``width`` leaves more
    rows per home for the window functions that follow, and so weakens their bound.
    """
    aggregates = [F.avg(source).alias(target) for source, target in measures.items()]
    if count_as:
        aggregates.append(F.count(F.lit(1)).alias(count_as))
    return (
        df.groupBy(key, F.window(ts, width).alias("w"))
        .agg(*aggregates)
        .withColumn(ts, F.col("w.start"))
        .select(key, ts, *measures.values(), *([count_as] if count_as else []))
    )


def _ordered(by: str, key: str, ts: str) -> WindowSpec:
    if by not in ("rows", "time"):
        raise ValueError(f"by must be 'rows' or 'time', not {by!r}")
    home = Window.partitionBy(key)
    return home.orderBy(ts) if by == "rows" else home.orderBy(epoch_seconds(F.col(ts)))


def lag_columns(
    value: str = LABEL,
    lags: Sequence[int] = (1, 24),
    by: str = "rows",
    key: str = "home_id",
    ts: str = "ts",
    step: int = HOUR_SECONDS,
) -> dict[str, Column]:
    """``lag_<n>`` per home: ``n`` rows back, or exactly ``n`` steps of time back.

    The two differ as soon as a home has hours without a reading.
    """
    order = _ordered(by, key, ts)
    if by == "rows":
        return {f"lag_{n}": F.lag(value, n).over(order) for n in lags}
    return {
        f"lag_{n}": F.max(value).over(order.rangeBetween(-n * step, -n * step)) for n in lags
    }


def rolling_columns(
    value: str = LABEL,
    size: int = 24,
    by: str = "rows",
    include_current: bool = True,
    key: str = "home_id",
    ts: str = "ts",
    step: int = HOUR_SECONDS,
) -> dict[str, Column]:
    """``rolling_mean_<size>`` and sample ``rolling_std_<size>`` per home.

    With ``include_current`` the frame ends at the row itself. If ``value`` is also
    what a model predicts, that leaks the answer into the features; pass ``False``
    to end the frame one row (or step) earlier.
    """
    order = _ordered(by, key, ts)
    end = 0 if include_current else 1
    first, last = -(size - 1 + end), -end
    if by == "rows":
        frame = order.rowsBetween(first, last)
    else:
        frame = order.rangeBetween(first * step, last * step)
    return {
        f"rolling_mean_{size}": F.avg(value).over(frame),
        f"rolling_std_{size}": F.stddev_samp(value).over(frame),
    }


def with_lags(series: DataFrame, **options) -> DataFrame:
    return series.withColumns(lag_columns(**options))


def with_rolling(series: DataFrame, **options) -> DataFrame:
    return series.withColumns(rolling_columns(**options))


def with_calendar(series: DataFrame, ts: str = "ts") -> DataFrame:
    return series.withColumns(calendar_parts(F.col(ts)))


def featured_series(
    hourly: DataFrame,
    by: str = "rows",
    include_current: bool = True,
    required: Sequence[str] | None = REQUIRED,
) -> DataFrame:
    """Hourly series with lags, rolling statistics and calendar parts.

    All windows share one order per home, so they run in one sort after one shuffle.
    Rows with NULL in a ``required`` column are dropped; ``None`` keeps every row.
    """
    columns = {
        **lag_columns(by=by),
        **rolling_columns(by=by, include_current=include_current),
        **calendar_parts(F.col("ts")),
    }
    featured = hourly.withColumns(columns)
    return featured if required is None else featured.dropna(subset=list(required))


def stage_counts(
    raw: DataFrame, featured: DataFrame, required: Sequence[str] = REQUIRED
) -> DataFrame:
    """Rows after each stage: in, with timestamp, hourly, with all required features.

    ``featured`` keeps every hour (``required=None``) and the ``readings`` it merged,
    so the last three counts are one pass over it.
    """
    usable = F.lit(True)
    for name in required:
        usable = usable & ~missing(F.col(name))
    rows_in = raw.agg(F.count(F.lit(1)).alias("rows")).scalar()
    return featured.agg(
        F.coalesce(F.sum("readings"), F.lit(0)).alias("rows_parsed"),
        F.count(F.lit(1)).alias("rows_hourly"),
        F.count_if(usable).alias("rows_featured"),
    ).select(rows_in.alias("rows_in"), "*")
