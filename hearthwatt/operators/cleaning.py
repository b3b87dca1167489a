"""From raw readings to clean readings, and a report of what was lost on the way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clock_hour, missing, number, parse_date, reading_timestamp
from ..functions.parsing import ISO_DATE
from ..schema import ENERGY_RANGE, MEASURES, READING_NAMES


def rename_readings(df: DataFrame, names: Mapping[str, str] = READING_NAMES) -> DataFrame:
    """Raw column titles to working names; columns not listed are kept as they are."""
    return df.withColumnsRenamed(dict(names))


def cast_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as double; text that is no number, and NaN, become NULL."""
    return df.withColumns({name: number(F.col(name)) for name in columns})


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL or NaN in ``subset`` (default: in any column)."""
    return df.dropna(subset=None if subset is None else list(subset))


def drop_repeats(df: DataFrame) -> DataFrame:
    """Distinct rows.

    Copies are merged within each task before the shuffle, so many copies of one
    row cost no more network than one copy per task.
    """
    return df.dropDuplicates()


def keep_open_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows with ``low < column < high``; both ends are excluded."""
    value = F.col(column)
    return df.filter((value > low) & (value < high))


def keep_parsed(df: DataFrame, column: str = "ts") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def with_reading_calendar(
    df: DataFrame, date_formats: Sequence[str] = (ISO_DATE,)
) -> DataFrame:
    """Adds ``hour, date_parsed, month, year, day_of_week`` from the text columns."""
    return df.withColumns(
        {"hour": clock_hour(F.col("time")), "date_parsed": parse_date(F.col("date"), date_formats)}
    ).withColumns(
        {
            "month": F.month("date_parsed"),
            "year": F.year("date_parsed"),
            "day_of_week": F.dayofweek("date_parsed"),
        }
    )


def clean_readings(
    raw: DataFrame,
    energy_range: tuple[float, float] = ENERGY_RANGE,
    require_calendar: bool = False,
    date_formats: Sequence[str] = (ISO_DATE,),
) -> DataFrame:
    """The 13-column clean table behind all household reports.

    Rows with a missing value, repeated rows and implausible readings are dropped.
    Row filters come before the duplicate removal and the derived columns after it,
    so its shuffle carries only surviving rows and stored columns. A row whose date
    or time text does not parse is kept with NULL parts, as reports that ignore time
    still count it; ``require_calendar=True`` drops it.
    """
    complete = drop_nulls(rename_readings(raw), list(READING_NAMES.values()))
    plausible = keep_open_range(complete, "energy_consumption", *energy_range)
    clean = with_reading_calendar(drop_repeats(plausible.select(*READING_NAMES.values())), date_formats)
    return drop_nulls(clean, ["hour", "date_parsed"]) if require_calendar else clean


def with_timestamp(
    df: DataFrame, date_formats: Sequence[str] = (ISO_DATE,), ts: str = "ts"
) -> DataFrame:
    """Adds the reading's timestamp; works on text and on typed date/time columns."""
    types = {field.name: field.dataType for field in df.schema.fields}
    date, time = F.col("date"), F.col("time")
    if isinstance(types["date"], (T.TimestampType, T.TimestampNTZType)):
        date = date.cast("date")
    if isinstance(types["time"], (T.TimestampType, T.TimestampNTZType)):
        time = F.date_format(time, "HH:mm:ss")
    return df.withColumn(
        ts, reading_timestamp(date.cast("string"), time.cast("string"), date_formats)
    )


def timestamped_readings(
    raw: DataFrame, date_formats: Sequence[str] = (ISO_DATE,)
) -> DataFrame:
    """Readings with a usable timestamp, ready for the hourly rollup.

    Unlike ``clean_readings`` this neither removes repeats nor outliers.
    """
    stamped = with_timestamp(rename_readings(raw), date_formats)
    return cast_numeric(keep_parsed(stamped), MEASURES).select("home_id", "ts", *MEASURES)


def quality_report(
    raw: DataFrame,
    energy_range: tuple[float, float] = ENERGY_RANGE,
    date_formats: Sequence[str] = (ISO_DATE,),
) -> DataFrame:
    """One row of counts, from one scan: what is wrong with the raw readings."""
    df = with_timestamp(rename_readings(raw), date_formats)
    energy = number(F.col("energy_consumption"))
    measures = [missing(F.col(name)) for name in MEASURES]
    others = [F.col(name).isNull() for name in READING_NAMES.values() if name not in MEASURES]
    any_null = reduce(or_, measures + others)
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(any_null).alias("rows_with_null"),
        F.count_if(parse_date(F.col("date").cast("string"), date_formats).isNull()).alias("unparsed_date"),
        F.count_if(clock_hour(F.col("time").cast("string")).isNull()).alias("unparsed_hour"),
        F.count_if(F.col("ts").isNull()).alias("unparsed_ts"),
        F.count_if((energy <= energy_range[0]) | (energy >= energy_range[1])).alias("out_of_range"),
    )
