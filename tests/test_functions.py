from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hearthwatt.functions import (
    calendar_parts,
    clock_hour,
    fixed_width_bin,
    in_first_share,
    parse_date,
    percent_difference,
    reading_timestamp,
)

HOURS = {
    "21:12": 21,
    "21:12:00": 21,
    "2023-12-02 21:12:00": 21,
    " 06:39 ": 6,
    "6:39": 6,
    "7": 7,
    "00:00": 0,
    "": None,
    "abc": None,
    "25:00": None,
    "2023-12-02": None,
    None: None,
}


@pytest.mark.parametrize("text,expected", HOURS.items())
def test_clock_hour(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(clock_hour(F.col("t"))).first()[0] == expected


def test_parse_date_formats(spark):
    df = spark.createDataFrame([("2023-12-02",), ("02/12/2023",), ("",), (None,), ("2023-13-40",)], "d string")
    iso = [r[0] for r in df.select(parse_date(F.col("d"))).collect()]
    both = [r[0] for r in df.select(parse_date(F.col("d"), ["yyyy-MM-dd", "dd/MM/yyyy"])).collect()]
    assert iso == [date(2023, 12, 2), None, None, None, None]
    assert both == [date(2023, 12, 2), date(2023, 12, 2), None, None, None]


TIMESTAMPS = [
    ("2023-12-02", "21:12", datetime(2023, 12, 2, 21, 12)),
    ("2023-12-02", "21:12:30", datetime(2023, 12, 2, 21, 12, 30)),
    ("2023-12-02", "1999-01-01 06:07:08", datetime(2023, 12, 2, 6, 7, 8)),
    ("2023-12-02", " 9:05 ", datetime(2023, 12, 2, 9, 5)),
    ("2023-12-02", "25:00", None),
    ("2023-12-02", "12:60", None),
    ("2023-12-02", "abc", None),
    ("2023-12-02", None, None),
    (None, "21:12", None),
    ("02/12/2023", "21:12", None),
]


@pytest.mark.parametrize("day,time,expected", TIMESTAMPS)
def test_reading_timestamp(spark, day, time, expected):
    df = spark.createDataFrame([(day, time)], "d string, t string")
    assert df.select(reading_timestamp(F.col("d"), F.col("t"))).first()[0] == expected


def test_timestamp_ignores_session_zone(spark):
    """02:30 does not exist in New York on this day; a reading still keeps its time."""
    df = spark.createDataFrame([("2024-03-10", "02:30")], "d string, t string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(reading_timestamp(F.col("d"), F.col("t"))).first()[0] == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar_parts(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-06 13:30:00' ts UNION ALL SELECT timestamp_ntz'2024-01-08 00:00:00'")
    rows = df.select(*(c.alias(n) for n, c in calendar_parts(F.col("ts")).items())).collect()
    assert [tuple(r) for r in rows] == [(13, 7, 1, 1.0), (0, 2, 1, 0.0)]


def test_bins_keep_edges(spark):
    df = spark.createDataFrame([(0.39,), (0.4,), (0.8,), (1.2,), (19.99,)], "v double")
    assert [r[0] for r in df.select(fixed_width_bin(F.col("v"), 0.4)).collect()] == [0, 1, 2, 3, 49]
    with pytest.raises(ValueError):
        fixed_width_bin(F.col("v"), 0.333)


def test_percent_difference(spark):
    df = spark.createDataFrame([(12.0, 10.0), (1.0, 0.0), (1.0, None)], "p double, a double")
    assert [r[0] for r in df.select(percent_difference(F.col("p"), F.col("a"))).collect()] == [20.0, None, None]


@pytest.mark.parametrize("portable", [True, False])
def test_share_of_keys(spark, portable):
    df = spark.range(20000)
    small = df.filter(in_first_share(0.1, "id", portable=portable))
    large = df.filter(in_first_share(0.3, "id", portable=portable))
    assert abs(small.count() - 2000) < 200
    assert small.subtract(large).isEmpty()
    assert df.filter(in_first_share(1.0, "id", portable=portable)).count() == 20000
    assert df.filter(in_first_share(0.0, "id", portable=portable)).isEmpty()


def test_share_tells_null_positions_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    differs = False
    for seed in range(20):
        flags = [r[0] for r in df.select(in_first_share(0.5, "x", "y", seed=seed)).collect()]
        differs |= flags[0] != flags[1]
    assert differs
