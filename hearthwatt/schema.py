"""Declared schemas and the column names the library works with."""

from __future__ import annotations

from pyspark.sql import types as T

# The column titles of the raw meter export, with declared types.
# ``Time`` and ``Date`` stay text: inferring them stamps times with today's date.
RAW_READING = T.StructType(
    [
        T.StructField("Home ID", T.LongType()),
        T.StructField("Appliance Type", T.StringType()),
        T.StructField("Energy Consumption (kWh)", T.DoubleType()),
        T.StructField("Time", T.StringType()),
        T.StructField("Date", T.StringType()),
        T.StructField("Outdoor Temperature (°C)", T.DoubleType()),
        T.StructField("Season", T.StringType()),
        T.StructField("Household Size", T.IntegerType()),
    ]
)

# Raw title -> working name.
READING_NAMES = {
    "Home ID": "home_id",
    "Appliance Type": "appliance_type",
    "Energy Consumption (kWh)": "energy_consumption",
    "Time": "time",
    "Date": "date",
    "Outdoor Temperature (°C)": "outdoor_temperature",
    "Season": "season",
    "Household Size": "household_size",
}

# Working columns that hold measurements and are cast to double for the series.
MEASURES = ("energy_consumption", "outdoor_temperature", "household_size")

# Open range of plausible readings, in kWh.
ENERGY_RANGE = (0.0, 20.0)

# A what-if row. ``day_of_week`` follows Spark's convention: 1 = Sunday.
SCENARIO = T.StructType(
    [
        T.StructField("appliance_type", T.StringType()),
        T.StructField("outdoor_temperature", T.DoubleType()),
        T.StructField("season", T.StringType()),
        T.StructField("household_size", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
    ]
)

METRICS_SUMMARY = T.StructType(
    [T.StructField("model", T.StringType())]
    + [
        T.StructField(f"{split}_{metric}", T.DoubleType())
        for split in ("val", "test")
        for metric in ("rmse", "mae", "mape")
    ]
)
