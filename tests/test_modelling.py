from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import daily_cycle, series
from hearthwatt.operators import (
    average_by,
    check_categories,
    featured_series,
    fit_forecast,
    fit_household,
    index_categories,
    load_model,
    metric_table,
    save_model,
    scale_columns,
    score_scenarios,
    split_by_time,
    spread,
)
from hearthwatt.operators.modelling import TRAINING_PARTITIONS
from hearthwatt.operators.series import FEATURES

QUICK = {
    "linear": {"maxIter": 50},
    "forest": {"numTrees": 10, "maxDepth": 5, "seed": 42},
    "gbt": {"maxIter": 5, "maxDepth": 4, "seed": 42},
}


@pytest.fixture(scope="module")
def split(spark):
    featured = featured_series(series(spark, daily_cycle()), include_current=False)
    return split_by_time(featured).cache()


@pytest.fixture(scope="module")
def forecast(split):
    return fit_forecast(split.filter("split = 'train'"), QUICK)


@pytest.fixture(scope="module")
def household(spark):
    """Consumption is fixed by appliance and temperature."""
    base = {"Heater": 8.0, "Television": 1.0, "Refrigerator": 3.0}
    rows = [
        (appliance, float(t), season, 1 + t % 5, (t * 5) % 24, 1 + t % 12, 1 + t % 7, level + 0.05 * t)
        for appliance, level in base.items()
        for t in range(0, 40)
        for season in ("Winter", "Summer")
    ]
    return spark.createDataFrame(
        rows,
        "appliance_type string, outdoor_temperature double, season string, household_size int, hour int, "
        "month int, day_of_week int, energy_consumption double",
    ).cache()


def test_models_beat_the_recent_mean(split, forecast):
    scored = forecast.score(split.filter("split <> 'train'"))
    columns = {**forecast.predictions(), "recent mean": "rolling_mean_24"}
    table = {r["model"]: r for r in metric_table(scored, columns, "consumption").collect()}
    assert all(table[m]["rmse"] < table["recent mean"]["rmse"] / 2 for m in QUICK)


def test_linear_model_against_least_squares(split, forecast):
    train = split.filter("split = 'train'").toPandas()
    test = split.filter("split <> 'train'")
    columns = list(FEATURES)
    constant = train[columns].std() == 0
    used = [c for c in columns if not constant[c]]
    design = np.column_stack([np.ones(len(train)), train[used]])
    weights, *_ = np.linalg.lstsq(design, train["consumption"], rcond=None)
    scored = forecast.score(test).toPandas()
    expected = np.column_stack([np.ones(len(scored)), scored[used]]) @ weights
    assert np.allclose(scored["prediction_linear"], expected, atol=1e-6)


def test_saved_model_scores_raw_features_alike(spark, split, forecast, tmp_path):
    test = split.filter("split = 'test'")
    for name in QUICK:
        save_model(forecast.pipeline(name), str(tmp_path / name))
        loaded = load_model(str(tmp_path / name)).transform(test)
        before = {(r["home_id"], r["ts"]): r[f"prediction_{name}"] for r in forecast.score(test).collect()}
        after = {(r["home_id"], r["ts"]): r["prediction"] for r in loaded.collect()}
        assert before == after


def test_rows_with_missing_numbers_are_kept_without_prediction(split, forecast):
    test = split.filter("split = 'test'")
    holed = test.withColumn("outdoor_temp", F.when(F.col("home_id") != 1, F.col("outdoor_temp")))
    scored = forecast.score(holed)
    assert scored.count() == test.count()
    for column in forecast.predictions().values():
        missing = {r["home_id"] for r in scored.filter(F.col(column).isNull()).collect()}
        assert missing == {1}


def test_fit_uses_training_rows_only(spark, split):
    def scaler_figures(df):
        fitted = fit_forecast(df.filter("split = 'train'"), {"linear": {"maxIter": 5}})
        return list(fitted.steps[1].mean), list(fitted.steps[1].std)

    changed = split.withColumn(
        "consumption", F.when(F.col("split") == "test", 1e6).otherwise(F.col("consumption"))
    )
    for name in FEATURES[:6]:
        changed = changed.withColumn(name, F.when(F.col("split") == "test", 1e6).otherwise(F.col(name)))
    assert scaler_figures(split) == scaler_figures(changed)


def test_later_values_do_not_reach_training_features(spark):
    base = series(spark, daily_cycle(days=5, homes=2))
    # training ends at 0.8 of the hours 24..119, which is hour 100
    late = F.col("ts") > F.lit(datetime(2024, 1, 5, 4))
    changed = base.withColumn("consumption", F.when(late, 500.0).otherwise(F.col("consumption")))

    def train(df):
        rows = split_by_time(featured_series(df)).filter("split = 'train'")
        return rows.orderBy("home_id", "ts").collect()

    assert train(base) == train(changed)


def test_category_index_order_and_unseen(spark):
    df = spark.createDataFrame(
        [("b", "x"), ("b", "x"), ("a", "x"), ("c", "x")], "appliance_type string, season string"
    )
    index = {r["appliance_type"]: r["appliance_index"] for r in index_categories(df).collect()}
    assert index == {"b": 0.0, "a": 1.0, "c": 2.0}


def test_scaling_uses_the_deviation_of_the_training_rows(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    df = spark.createDataFrame([(2.0,), (None,)], "v double")
    deviation = 2**0.5
    plain = [r["v_scaled"] for r in scale_columns(train, df, ["v"], center=False).collect()]
    centred = [r["v_scaled"] for r in scale_columns(train, df, ["v"], center=True).collect()]
    assert plain == [pytest.approx(2 / deviation), None]
    assert centred == [pytest.approx(0.0), None]


def test_many_categories_fit_into_the_tree_bins(spark):
    rows = [(f"kind {i}", 10.0, "Winter", 2, 5, 1, 1, float(i % 9)) for i in range(60)] * 3
    df = spark.createDataFrame(
        rows,
        "appliance_type string, outdoor_temperature double, season string, household_size int, hour int, "
        "month int, day_of_week int, energy_consumption double",
    )
    fitted = fit_household(df, {"tree": {"maxDepth": 5, "seed": 42}})
    table = metric_table(fitted.score(df), fitted.predictions(), "energy_consumption").first()
    assert table["rmse"] < 0.5


@pytest.mark.parametrize("parallelism", [1, 3])
def test_household_models_and_scenarios(spark, household, tmp_path, parallelism):
    settings = {
        "tree": {"maxDepth": 6, "seed": 42},
        "forest": {"numTrees": 10, "maxDepth": 6, "seed": 42},
        "gbt": {"maxIter": 5, "maxDepth": 4, "seed": 42},
    }
    fitted = fit_household(household, settings, parallelism=parallelism)
    table = metric_table(fitted.score(household), fitted.predictions(), "energy_consumption")
    assert all(r["r2"] > 0.9 for r in table.collect())

    save_model(fitted.pipeline("tree"), str(tmp_path / "tree"))
    scenarios = spark.createDataFrame(
        [
            (1, "Heater", 30.0, "Winter", 2, 12, 6, 3),
            (2, "Kettle", 30.0, "Autumn", 2, 12, 6, 3),
            (3, "Heater", None, "Winter", 2, 12, 6, 3),
        ],
        "id int, appliance_type string, outdoor_temperature double, season string, household_size int, "
        "hour int, month int, day_of_week int",
    )
    rows = {
        r["id"]: r
        for r in score_scenarios(load_model(str(tmp_path / "tree")), scenarios, average_by(household)).collect()
    }
    assert rows[1]["prediction"] == pytest.approx(9.5, abs=0.5)
    assert rows[1]["percent_difference"] == pytest.approx(
        (rows[1]["prediction"] - rows[1]["group_average"]) / rows[1]["group_average"] * 100
    )
    assert rows[2]["prediction"] is not None and rows[2]["group_average"] is None
    assert rows[3]["prediction"] is None and rows[3]["group_average"] is not None


def test_spread_does_not_follow_from_the_files(spark):
    few, many = spark.range(100).coalesce(1), spark.range(0, 100, 1, 16)
    counts = {spread(df, ["id"]).rdd.getNumPartitions() for df in (few, many)}
    assert counts == {TRAINING_PARTITIONS}
    assert spread(few, ["id"], 3).rdd.getNumPartitions() == 3


def test_too_many_categories_are_an_error(spark, monkeypatch):
    monkeypatch.setattr("hearthwatt.operators.modelling.MOST_CATEGORIES", 3)
    df = spark.range(5).selectExpr("cast(id as string) AS appliance_type", "'a' AS season")
    with pytest.raises(ValueError, match="appliance_type has 5 labels"):
        check_categories(df)
