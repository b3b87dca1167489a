from datetime import date, datetime

from fixtures import reading
from hearthwatt.operators import (
    cast_numeric,
    clean_readings,
    drop_nulls,
    drop_repeats,
    quality_report,
    rename_readings,
    timestamped_readings,
    with_timestamp,
)
from hearthwatt.schema import RAW_READING


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_READING)


def test_clean_schema_and_values(spark):
    clean = clean_readings(raw(spark, reading()))
    assert [(f.name, f.dataType.simpleString()) for f in clean.schema.fields] == [
        ("home_id", "bigint"),
        ("appliance_type", "string"),
        ("energy_consumption", "double"),
        ("time", "string"),
        ("date", "string"),
        ("outdoor_temperature", "double"),
        ("season", "string"),
        ("household_size", "int"),
        ("hour", "int"),
        ("date_parsed", "date"),
        ("month", "int"),
        ("year", "int"),
        ("day_of_week", "int"),
    ]
    assert tuple(clean.first()) == (*reading(), 21, date(2023, 12, 2), 12, 2023, 7)


def test_clean_drops_nulls_repeats_and_outliers(spark):
    nulls = [
        reading(**{name: None})
        for name in ("home", "appliance", "energy", "time", "date", "temperature", "season", "size")
    ]
    energies = [reading(energy=e) for e in (-1.0, 0.0, 19.99, 20.0, 25.5)]
    clean = clean_readings(raw(spark, reading(), reading(), *nulls, *energies, reading(energy=float("nan"))))
    assert sorted(r["energy_consumption"] for r in clean.collect()) == [3.5, 19.99]


def test_unparsed_rows_are_kept_unless_required(spark):
    df = raw(spark, reading(), reading(time="abc"), reading(date="02/12/2023"))
    assert clean_readings(df).count() == 3
    assert clean_readings(df, require_calendar=True).count() == 1


def test_drop_nulls_subset(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert drop_nulls(df).count() == 1
    assert drop_nulls(df, ["a"]).count() == 2


def test_drop_repeats_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    assert drop_repeats(df).count() == 2


def test_cast_numeric_bad_text_is_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert [r["v"] for r in cast_numeric(df, ["v"]).collect()] == [1.5, None, None]


def test_typed_time_and_date_columns(spark):
    typed = raw(spark, reading()).selectExpr(
        "`Home ID`",
        "`Appliance Type`",
        "cast(`Energy Consumption (kWh)` as string) as `Energy Consumption (kWh)`",
        "timestamp'2025-05-05 21:12:00' as Time",
        "date'2023-12-02' as Date",
        "`Outdoor Temperature (°C)`",
        "Season",
        "`Household Size`",
    )
    row = timestamped_readings(typed).first()
    assert tuple(row) == (1, datetime(2023, 12, 2, 21, 12), 3.5, -2.5, 4.0)


def test_timestamped_keeps_repeats_and_outliers(spark):
    df = raw(spark, reading(), reading(), reading(energy=500.0), reading(time="abc"))
    assert timestamped_readings(df).count() == 3


def test_quality_report(spark):
    df = raw(
        spark,
        reading(),
        reading(appliance=None),
        reading(time="abc"),
        reading(date="02/12/2023"),
        reading(date=None),
        reading(energy=20.0),
        reading(time="25:00"),
    )
    assert quality_report(df).first().asDict() == {
        "rows_in": 7,
        "rows_with_null": 2,
        "unparsed_date": 2,
        "unparsed_hour": 2,
        "unparsed_ts": 4,
        "out_of_range": 1,
    }


def test_with_timestamp_type(spark):
    df = with_timestamp(rename_readings(raw(spark, reading())))
    assert dict(df.dtypes)["ts"] == "timestamp_ntz"
