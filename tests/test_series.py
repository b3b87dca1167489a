from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fixtures import daily_cycle, series
from hearthwatt.operators import featured_series, hourly_rollup, with_lags, with_rolling


def values(df, column):
    return [r[column] for r in df.orderBy("home_id", "ts").collect()]


def test_rollup_means_and_window_start(spark):
    rows = [
        (1, datetime(2024, 1, 1, 10, 20), 1.0, 10.0, 2),
        (1, datetime(2024, 1, 1, 10, 59, 59), 3.0, 20.0, 3),
        (1, datetime(2024, 1, 1, 11, 0), 5.0, 0.0, 2),
        (2, datetime(2024, 1, 1, 10, 0), 7.0, None, 2),
    ]
    df = spark.createDataFrame(
        rows,
        "home_id bigint, ts timestamp_ntz, energy_consumption double, outdoor_temperature double, household_size int",
    )
    result = hourly_rollup(df, count_as="readings").orderBy("home_id", "ts")
    assert dict(result.dtypes)["ts"] == "timestamp_ntz"
    assert [tuple(r) for r in result.collect()] == [
        (1, datetime(2024, 1, 1, 10), 2.0, 15.0, 2.5, 2),
        (1, datetime(2024, 1, 1, 11), 5.0, 0.0, 2.0, 1),
        (2, datetime(2024, 1, 1, 10), 7.0, None, 2.0, 1),
    ]


def test_rollup_hours_do_not_follow_the_session_zone(spark):
    df = spark.sql("SELECT 1L home_id, timestamp_ntz'2024-01-01 10:20:00' ts, 1D energy_consumption")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        rolled = hourly_rollup(df, {"energy_consumption": "consumption"})
        assert rolled.first()["ts"] == datetime(2024, 1, 1, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lag_by_rows_and_by_time_differ_over_a_gap(spark):
    df = series(spark, {1: [(h, float(h)) for h in range(30) if h != 5]})
    rows = {r["ts"].hour + 24 * (r["ts"].day - 1): r for r in with_lags(df).collect()}
    timed = {r["ts"].hour + 24 * (r["ts"].day - 1): r for r in with_lags(df, by="time").collect()}
    assert rows[6]["lag_1"] == 4.0 and timed[6]["lag_1"] is None
    assert rows[28]["lag_24"] == 3.0 and timed[28]["lag_24"] == 4.0
    assert timed[29]["lag_24"] is None


def test_rolling_edges(spark):
    one = with_rolling(series(spark, {1: [(0, 4.0)]})).first()
    assert (one["rolling_mean_24"], one["rolling_std_24"]) == (4.0, None)
    constant = with_rolling(series(spark, {1: [(h, 2.0) for h in range(25)]}))
    assert set(values(constant, "rolling_mean_24")) == {2.0}
    assert set(values(constant, "rolling_std_24")) == {None, 0.0}
    grown = with_rolling(series(spark, {1: [(h, float(h)) for h in range(25)]}))
    assert values(grown, "rolling_mean_24")[-1] == sum(range(1, 25)) / 24
    prior = with_rolling(series(spark, {1: [(h, float(h)) for h in range(25)]}), include_current=False)
    assert values(prior, "rolling_mean_24")[0] is None
    assert values(prior, "rolling_mean_24")[-1] == sum(range(24)) / 24


def test_rolling_by_time_skips_missing_hours(spark):
    df = series(spark, {1: [(0, 100.0), (23, 1.0), (24, 3.0)]})
    assert values(with_rolling(df, by="time"), "rolling_mean_24") == [100.0, 50.5, 2.0]
    assert values(with_rolling(df, by="time", include_current=False), "rolling_mean_24") == [None, 100.0, 50.5]


@pytest.mark.parametrize("length,expected", [(1, 0), (24, 0), (25, 1), (30, 6)])
def test_featured_needs_a_day_of_history(spark, length, expected):
    assert featured_series(series(spark, {1: [(h, 1.0 * h) for h in range(length)]})).count() == expected


def test_homes_do_not_mix(spark):
    df = series(spark, {1: [(h, 1.0) for h in range(30)], 2: [(h, 9.0) for h in range(30)]})
    rows = featured_series(df).collect()
    assert {(r["home_id"], r["lag_1"], r["rolling_mean_24"]) for r in rows} == {(1, 1.0, 1.0), (2, 9.0, 9.0)}


@pytest.mark.parametrize("by", ["rows", "time"])
def test_prior_features_do_not_see_their_own_hour(spark, by):
    base = series(spark, daily_cycle(days=3, homes=1))
    cut = datetime(2024, 1, 3, 5)
    changed = base.withColumn("consumption", F.when(F.col("ts") == F.lit(cut), 99.0).otherwise(F.col("consumption")))
    inputs = ["lag_1", "lag_24", "rolling_mean_24", "rolling_std_24"]

    def features(df):
        rows = featured_series(df, by=by, include_current=False).filter(F.col("ts") <= F.lit(cut))
        return rows.select("ts", *inputs).orderBy("ts").collect()

    assert features(base) == features(changed)


def test_unknown_order_is_refused(spark):
    with pytest.raises(ValueError):
        with_lags(series(spark, {1: [(0, 1.0)]}), by="days")
