import math
from datetime import datetime, timedelta

import pytest

from hearthwatt.operators import hourly_rollup
from hearthwatt.plans.forecast import run_forecast
from hearthwatt.plans.household import PROFILED, REPORTS, run_household
from hearthwatt.schema import METRICS_SUMMARY, RAW_READING, SCENARIO
from hearthwatt.sources import literal_rows

APPLIANCES = ("Refrigerator", "Air Conditioner", "Washing Machine", "Heater", "Television")
QUICK = {
    "linear": {"maxIter": 20},
    "forest": {"numTrees": 5, "maxDepth": 4, "seed": 42},
    "gbt": {"maxIter": 3, "maxDepth": 3, "seed": 42},
}


@pytest.fixture(scope="module")
def raw(spark):
    """Twelve days of three homes, an hour apart, with a daily cycle."""
    start = datetime(2024, 1, 1)
    rows = []
    for home in range(3):
        for h in range(24 * 12):
            ts = start + timedelta(hours=h)
            energy = 5 + home + 2 * math.sin(2 * math.pi * (h % 24) / 24)
            rows.append(
                (home, APPLIANCES[h % 5], energy, ts.strftime("%H:%M"), ts.strftime("%Y-%m-%d"),
                 float(h % 17), "Winter", home + 2)
            )
    rows.append((0, "Heater", 4.0, "abc", "2024-01-01", 1.0, "Winter", 2))
    rows.append((0, "Heater", 400.0, "03:00", "2024-01-02", 1.0, "Winter", 2))
    return spark.createDataFrame(rows, RAW_READING)


def test_forecast_job(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    out = str(tmp_path / "out")
    best = run_forecast(spark, str(tmp_path / "raw"), out, QUICK)
    assert best in QUICK

    quality = spark.read.parquet(f"{out}/quality").first()
    assert quality.asDict() == {
        "rows_in": 866, "rows_parsed": 865, "rows_hourly": 864, "rows_featured": 864 - 3 * 24,
    }
    summary = spark.read.schema(METRICS_SUMMARY).option("header", True).csv(f"{out}/metrics_summary").collect()
    assert len(summary) == 1 and summary[0]["model"] == best
    metrics = {(r["model"], r["split"]): r for r in spark.read.parquet(f"{out}/metrics").collect()}
    assert len(metrics) == 6
    assert best == min(QUICK, key=lambda name: (metrics[name, "val"]["rmse"], name))
    assert summary[0]["test_rmse"] == pytest.approx(metrics[best, "test"]["rmse"])
    assert not metrics[best, "val"]["features_include_current"]

    splits = {r["split"]: r for r in spark.read.parquet(f"{out}/splits").collect()}
    assert sum(r["rows"] for r in splits.values()) == quality["rows_featured"]
    assert splits["train"]["max_ts"] < splits["val"]["min_ts"] <= splits["test"]["min_ts"]

    predictions = spark.read.parquet(f"{out}/predictions")
    assert predictions.columns == ["home_id", "ts", "label", "prediction"]
    assert predictions.count() == metrics[best, "test"]["rows"]
    assert predictions.filter("prediction IS NULL").isEmpty()
    # a second run replaces the first
    assert run_forecast(spark, str(tmp_path / "raw"), out, {"linear": QUICK["linear"]}, by="time") == "linear"


def test_household_job(spark, raw, tmp_path):
    raw.unionByName(raw).coalesce(2).write.option("header", True).csv(str(tmp_path / "raw"))
    out = str(tmp_path / "out")
    settings = {"tree": {"maxDepth": 4, "seed": 42}, "forest": {"numTrees": 3, "maxDepth": 4, "seed": 42}}
    scenarios = literal_rows(
        spark, [("Heater", 3.0, "Winter", 2, 12, 1, 3), ("Kettle", 3.0, "Winter", 2, 12, 1, 3)], SCENARIO
    )
    best = run_household(spark, str(tmp_path / "raw"), out, "csv", settings, scenarios)
    assert best in settings

    assert spark.read.parquet(f"{out}/clean").count() == 865
    assert spark.read.parquet(f"{out}/quality").first()["rows_in"] == 2 * 866
    assert spark.read.parquet(f"{out}/schema").count() == 13
    for name in REPORTS:
        assert spark.read.parquet(f"{out}/reports/{name}").count() > 0 or name == "scatter"
    for name, column in PROFILED.items():
        rows = spark.read.parquet(f"{out}/reports/{name}").collect()
        assert {column} <= set(rows[0].asDict())
    totals = [r["total_consumption"] for r in spark.read.parquet(f"{out}/reports/by_appliance").collect()]
    assert totals == sorted(totals, reverse=True)
    hours = [r["hour"] for r in spark.read.parquet(f"{out}/reports/by_hour").collect() if r["hour"] is not None]
    assert hours == sorted(hours) and len(hours) == 24
    assert spark.read.parquet(f"{out}/split").columns[-1] == "split"
    metrics = {r["model"]: r for r in spark.read.parquet(f"{out}/metrics").collect()}
    assert set(metrics) == set(settings)
    assert metrics[best]["r2"] == max(r["r2"] for r in metrics.values())
    scored = {r["appliance_type"]: r for r in spark.read.parquet(f"{out}/scenarios").collect()}
    assert scored["Heater"]["percent_difference"] is not None
    assert scored["Kettle"]["prediction"] is not None and scored["Kettle"]["group_average"] is None


def test_rollup_of_one_busy_home(spark):
    """A home with nearly all readings is merged before and after the shuffle alike."""
    df = spark.range(0, 200_000, 1, 16).selectExpr(
        "if(id % 10 = 0, id % 7, 99) as home_id",
        "cast('2024-01-01' as timestamp_ntz) + make_dt_interval(0, 0, 0, id % 86400) as ts",
        "cast(id % 100 as double) as energy_consumption",
    )
    rolled = hourly_rollup(df, {"energy_consumption": "consumption"}, count_as="readings")
    rows = rolled.collect()
    assert len(rows) == 8 * 24
    assert sum(r["readings"] for r in rows) == 200_000
