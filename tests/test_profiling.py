import math

import pytest

from hearthwatt.operators import (
    by_date_hour,
    compare_to_average,
    correlation,
    describe_numeric,
    headline,
    histogram,
    profile_all,
    season_share,
)

COLUMNS = (
    "appliance_type string, energy_consumption double, outdoor_temperature double, season string, "
    "household_size int, date string, hour int, month int"
)


@pytest.fixture()
def clean(spark):
    return spark.createDataFrame(
        [
            ("Heater", 4.0, -2.0, "Winter", 2, "2024-01-01", 7, 1),
            ("Heater", 6.0, 0.0, "Winter", 3, "2024-01-01", 8, 1),
            ("Television", 1.0, 20.0, "Summer", 2, "2024-01-02", 7, 1),
            ("Television", 2.0, 25.0, "Summer", 5, "2024-01-02", None, 1),
        ],
        COLUMNS,
    )


def test_correlation_pairs(clean):
    table = {(r["x"], r["y"]): r["r"] for r in correlation(clean).collect()}
    assert len(table) == 25
    # month never varies: no correlation instead of a division by zero
    assert all(r is None for pair, r in table.items() if "month" in pair)
    assert table["energy_consumption", "energy_consumption"] == 1.0
    assert table["energy_consumption", "hour"] == table["hour", "energy_consumption"]
    # rows without an hour are left out of that pair only: (7, 4), (8, 6), (7, 1)
    x, y = [7, 8, 7], [4.0, 6.0, 1.0]
    mx, my = sum(x) / 3, sum(y) / 3
    expected = sum((a - mx) * (b - my) for a, b in zip(x, y)) / math.sqrt(
        sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)
    )
    assert table["hour", "energy_consumption"] == pytest.approx(expected)


def test_correlation_of_many_columns_against_pandas(spark):
    names = [f"c{i}" for i in range(7)]
    rows = [tuple(float((i * 37 + j * j * 11 + i * i * j) % 17) for j in range(7)) for i in range(60)]
    df = spark.createDataFrame(rows, names)
    expected = df.toPandas().corr()
    table = correlation(df, names).collect()
    assert len(table) == 49
    for row in table:
        assert row["r"] == pytest.approx(expected.loc[row["x"], row["y"]], abs=1e-12)


def test_describe_gives_numbers(clean):
    rows = {r["column"]: r for r in describe_numeric(clean).collect()}
    energy = rows["energy_consumption"]
    assert (energy["count"], energy["mean"], energy["min"], energy["max"]) == (4, 3.25, 1.0, 6.0)
    assert energy["stddev"] == pytest.approx(2.217356)


def test_headline(clean):
    assert tuple(headline(clean).first()) == (4, 3.25, 2, 3.0)


def test_histogram_counts_every_row_once(clean):
    rows = histogram(clean).collect()
    assert [(r["bin"], r["count"]) for r in rows] == [(2, 1), (5, 1), (10, 1), (15, 1)]


def test_season_share_of_empty_and_full(clean):
    assert {r["season"]: r["share"] for r in season_share(clean).collect()} == {"Winter": 0.5, "Summer": 0.5}
    assert season_share(clean.limit(0)).collect() == []


def test_by_date_hour_is_ordered_and_limited(clean):
    rows = [(r["date"], r["hour"]) for r in by_date_hour(clean, n=3).collect()]
    assert rows == [("2024-01-01", 7), ("2024-01-01", 8), ("2024-01-02", None)]


def test_profile_keeps_null_values_of_a_dimension(clean):
    rows = {(r["dimension"], r["value"]): r for r in profile_all(clean).collect()}
    assert rows["hour", None]["count"] == 1
    assert rows["hour", "7"]["avg_consumption"] == 2.5
    assert rows["appliance_type", "Heater"]["total_consumption"] == 10.0
    assert sum(r["count"] for (d, _), r in rows.items() if d == "season") == 4


def test_compare_to_average_keeps_unknown_groups(spark):
    scored = spark.createDataFrame([("Heater", 6.0), ("Kettle", 1.0), (None, 2.0)], "appliance_type string, prediction double")
    averages = spark.createDataFrame([("Heater", 5.0)], "appliance_type string, group_average double")
    rows = {r["appliance_type"]: r for r in compare_to_average(scored, averages).collect()}
    assert rows["Heater"]["percent_difference"] == pytest.approx(20.0)
    assert rows["Kettle"]["group_average"] is None and rows["Kettle"]["percent_difference"] is None
    assert len(rows) == 3
