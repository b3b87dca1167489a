"""Every operator as a query over the standard tables.

``events`` stands in for meter readings. Each query is a function of the session
and the table folder; ``plans.oracles`` holds the SQL that states the same result.
Doubles are rounded to six places, as engines add floating-point numbers in
different orders; means over short frames to eight, as they often lie
exactly between two values of six places, and large percentages to two.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as op
from ..functions import calendar_parts, clock_hour, parse_date
from ..operators.modelling import (
    FORECAST_SETTINGS,
    HOUSEHOLD_SETTINGS,
    assembler,
    category_indexer,
    fit_regressor,
    load_model,
    save_model,
)
from ..operators.series import FEATURES, REQUIRED
from ..sources import (
    preview_rows,
    read_csv_readings,
    read_parquet,
    shared_folder,
    write_parquet,
    write_single_csv,
    written_once,
)

BOTH_DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")

# One set of settings per model: those of the forecast, and the household tree.
SETTINGS = {**FORECAST_SETTINGS, "tree": HOUSEHOLD_SETTINGS["tree"]}

NAIVE = {"last_hour": "lag_1", "last_day": "lag_24", "rolling": "rolling_mean_24"}


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(F.col(name), places) for name in doubles})


# --- inputs ------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/events.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as readings under working names, with clock and calendar text."""
    return events(spark, sf_dir).select(
        "event_id",
        F.col("user_id").alias("home_id"),
        F.col("event_type").alias("appliance_type"),
        F.col("value").alias("energy_consumption"),
        "ts",
        F.date_format("ts", "HH:mm").alias("time"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        *_household(),
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an untidy raw export: mixed time and date text, gaps, no ids."""
    kind, ts = F.col("event_type"), F.col("ts")
    time = (
        F.when(kind == "click", F.date_format(ts, "HH:mm"))
        .when((kind == "view") & (F.col("user_id") % 2 == 0), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == "view", F.date_format(ts, "HH:mm:ss"))
        .when(kind == "purchase", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "signup", F.concat(F.lit(" "), F.date_format(ts, "HH:mm"), F.lit(" ")))
        .otherwise("n/a")
    )
    date = (
        F.when(kind == "purchase", F.date_format(ts, "dd/MM/yyyy"))
        .when(kind == "error", "")
        .otherwise(F.date_format(ts, "yyyy-MM-dd"))
    )
    temperature, season, size = _household()
    columns = {
        "Home ID": F.col("user_id"),
        "Appliance Type": F.nullif(kind, F.lit("error")),
        "Energy Consumption (kWh)": F.col("value"),
        "Time": time,
        "Date": date,
        "Outdoor Temperature (°C)": F.nullif(temperature, F.lit(-5.0)),
        "Season": season,
        "Household Size": size,
    }
    return events(spark, sf_dir).select(*(c.alias(name) for name, c in columns.items()))


def gappy_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The untidy export with NaN for some energies, which counts as missing."""
    energy = F.col("Energy Consumption (kWh)")
    gap = F.when(F.col("Home ID") % 50 == 7, F.lit(float("nan"))).otherwise(energy)
    return raw_readings(spark, sf_dir).withColumn("Energy Consumption (kWh)", gap)


def _household() -> tuple:
    return (
        F.expr("cast(get_json_object(props, '$.k') as int) * 0.5D - 5.0D").alias("outdoor_temperature"),
        F.expr(
            "element_at(array('Winter', 'Spring', 'Summer', 'Fall'), cast(user_id % 4 + 1 as int))"
        ).alias("season"),
        F.expr("cast(user_id % 5 + 1 as int)").alias("household_size"),
    )


def twice(df: DataFrame) -> DataFrame:
    """The table with every row repeated."""
    return df.unionByName(df)


def plausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings within the plausible range, with hour and month: the report input."""
    df = op.keep_open_range(readings(spark, sf_dir), "energy_consumption", 0, 20)
    return df.withColumns(
        {"hour": F.hour("ts"), "month": F.month("ts"), "day_of_week": F.dayofweek("ts")}
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hourly_rollup(readings(spark, sf_dir))


def split_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leak-free features with their time split, stored once for the fits."""
    return split_and_training(spark, sf_dir)[0]


def split_and_training(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """That series, and its training rows as a range of timestamps that the scan skips by."""
    series = op.featured_series(
        hourly(spark, sf_dir), include_current=False, required=("consumption", *FEATURES)
    )
    stored = written_once(series, "series")
    limits = op.time_limits(stored).first()
    split = op.split_by_time(stored, limits=limits)
    return split, op.spread(split.filter(op.within_split("train", limits)), ["home_id", "ts"])


# --- queries -----------------------------------------------------------------


def _series(**options) -> Callable:
    return lambda spark, d: rounded(op.with_lags(hourly(spark, d), **options)).select(
        "home_id", "ts", "consumption", "lag_1", "lag_24"
    )


def _rolling(**options) -> Callable:
    return lambda spark, d: rounded(op.with_rolling(hourly(spark, d), **options), 8).select(
        "home_id", "ts", "consumption", "rolling_mean_24", "rolling_std_24"
    )


def _report(function: Callable) -> Callable:
    return lambda spark, d: rounded(function(plausible(spark, d)))


def quality_report(spark: SparkSession, d: str) -> DataFrame:
    return op.quality_report(gappy_readings(spark, d), date_formats=BOTH_DATE_FORMATS)


def stage_counts(spark: SparkSession, d: str) -> DataFrame:
    raw = gappy_readings(spark, d)
    readings_ts = op.timestamped_readings(raw, BOTH_DATE_FORMATS)
    series = op.hourly_rollup(readings_ts, count_as="readings")
    return op.stage_counts(raw, op.featured_series(series, required=None))


def filter_parsed_ts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(op.timestamped_readings(raw_readings(spark, d), BOTH_DATE_FORMATS))


def cast_numeric(spark: SparkSession, d: str) -> DataFrame:
    """The JSON text of the events as a number; time text, which is none, as NULL."""
    df = events(spark, d).select(
        "event_id",
        F.get_json_object("props", "$.k").alias("level"),
        F.date_format("ts", "HH:mm").alias("clock"),
    )
    return op.cast_numeric(df, ["level", "clock"])


def parse_hour(spark: SparkSession, d: str) -> DataFrame:
    time = F.col("Time")
    return raw_readings(spark, d).select(
        F.col("Home ID").alias("home_id"), time.alias("time"), clock_hour(time).alias("hour")
    )


def parse_date_query(spark: SparkSession, d: str) -> DataFrame:
    date = F.col("Date")
    return raw_readings(spark, d).select(
        F.col("Home ID").alias("home_id"),
        date.alias("date"),
        parse_date(date).alias("date_iso"),
        parse_date(date, BOTH_DATE_FORMATS).alias("date_parsed"),
    )


def calendar_query(spark: SparkSession, d: str) -> DataFrame:
    """Calendar parts of order dates, which span several years."""
    orders = read_parquet(spark, f"{d}/orders.parquet")
    ts = F.col("o_orderdate")
    return orders.select(
        "o_orderkey",
        F.year(ts).alias("year"),
        *(part.alias(name) for name, part in calendar_parts(ts).items()),
    )


def build_timestamp(spark: SparkSession, d: str) -> DataFrame:
    stamped = op.with_timestamp(op.rename_readings(raw_readings(spark, d)), BOTH_DATE_FORMATS)
    return stamped.select("home_id", "date", "time", "ts")


def drop_null_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(op.featured_series(hourly(spark, d), required=REQUIRED), 8)


def featured_orders(spark: SparkSession, d: str) -> DataFrame:
    """Lags and rolling means of orders per customer, over several years."""
    orders = read_parquet(spark, f"{d}/orders.parquet")
    daily = op.hourly_rollup(
        orders, {"o_totalprice": "consumption"}, key="o_custkey", ts="o_orderdate", width="1 day"
    )
    keys = {"key": "o_custkey", "ts": "o_orderdate"}
    return rounded(op.with_rolling(op.with_lags(daily, lags=(1, 3), **keys), size=3, **keys), 6)


def split_by_time(spark: SparkSession, d: str) -> DataFrame:
    return op.split_by_time(hourly(spark, d)).select("home_id", "ts", "split")


def split_sizes(spark: SparkSession, d: str) -> DataFrame:
    return op.split_sizes(split_by_time(spark, d))


def scale_query(center: bool) -> Callable:
    def query(spark: SparkSession, d: str) -> DataFrame:
        df = readings(spark, d).select(
            "event_id", "energy_consumption", "outdoor_temperature", "household_size"
        )
        columns = df.columns[1:]
        scaled = op.scale_columns(df, df, columns, center)
        return rounded(scaled.select("event_id", *(f"{name}_scaled" for name in columns)))

    return query


def fitted_features(spark: SparkSession, d: str) -> DataFrame:
    """Features standardised by the figures of the training rows alone."""
    columns = ("lag_1", "lag_24", "rolling_mean_24", "outdoor_temp", "hour")
    df = op.split_by_time(written_once(op.featured_series(hourly(spark, d)), "series"))
    scaled = op.scale_columns(df.filter("split = 'train'"), df, columns, center=True)
    return rounded(scaled.select("home_id", "ts", "split", *(f"{c}_scaled" for c in columns)))


def index_categories(spark: SparkSession, d: str) -> DataFrame:
    df = readings(spark, d).select("event_id", "appliance_type", "season")
    return category_indexer().fit(df).transform(df)


def naive_forecast(spark: SparkSession, d: str) -> DataFrame:
    """Forecasts without a model: last hour, same row a day ago, recent mean."""
    series = op.featured_series(hourly(spark, d), include_current=False)
    return series.withColumn("label", F.col("consumption"))


def rounded_metrics(table: DataFrame) -> DataFrame:
    return rounded(table.withColumn("mape", F.round("mape", 6)))


def metric_suite(spark: SparkSession, d: str) -> DataFrame:
    return rounded_metrics(op.metric_suite(naive_forecast(spark, d), "label", "lag_1"))


def metric_mape(spark: SparkSession, d: str) -> DataFrame:
    table = op.metric_suite(naive_forecast(spark, d), "label", "lag_24", skip_zero=True)
    return rounded(table.select("rows", "mape", "zero_labels"))


def metric_table(spark: SparkSession, d: str) -> DataFrame:
    """The windows run once, for the stored series that the limits and metrics read."""
    stored = written_once(naive_forecast(spark, d), "naive")
    series = op.split_by_time(stored, limits=op.time_limits(stored).first())
    return rounded_metrics(op.metric_table(series, NAIVE, by=["split"]))


def best_model(spark: SparkSession, d: str) -> DataFrame:
    table = op.metric_table(naive_forecast(spark, d), NAIVE)
    return rounded(op.best_model(table).select("model", "rmse"))


def compare_to_average(spark: SparkSession, d: str) -> DataFrame:
    """Each reading against the mean of its appliance; unnamed appliances have none."""
    named = readings(spark, d).withColumn(
        "appliance_type", F.nullif(F.col("appliance_type"), F.lit("error"))
    )
    scored = named.select(
        "event_id", "appliance_type", F.col("energy_consumption").alias("prediction")
    )
    averages = written_once(op.average_by(named), "averages")
    return rounded(op.compare_to_average(scored, averages))


def _forecast(*names: str) -> Callable:
    def query(spark: SparkSession, d: str) -> DataFrame:
        series, train = split_and_training(spark, d)
        settings = {name: SETTINGS[name] for name in names}
        fitted = op.fit_forecast(train, settings)
        return fitted.score(series.filter("split <> 'train'")).select(
            "home_id",
            "ts",
            "split",
            F.col("consumption").alias("label"),
            *(F.col(c).alias("prediction" if len(names) == 1 else c) for c in fitted.predictions().values()),
        )

    return query


def forecast_holdout(spark: SparkSession, d: str) -> DataFrame:
    """Three models scored on validation and test rows."""
    names = ("linear", "forest", "gbt")
    scored = _forecast(*names)(spark, d)
    return rounded(op.metric_table(scored, {n: f"prediction_{n}" for n in names}, by=["split"]))


def forecast_preview(spark: SparkSession, d: str) -> DataFrame:
    test = _forecast("linear")(spark, d).filter("split = 'test'").drop("split")
    return preview_rows(test, ["ts", "home_id"], 10)


def _household_models(spark: SparkSession, d: str, *names: str) -> tuple:
    """Stored readings with their split, and models fitted on the training part."""
    split = written_once(op.hash_split(plausible(spark, d), ["event_id"]), "clean")
    train = op.spread(split.filter("split = 'train'"), ["event_id"])
    return split, op.fit_household(train, {name: HOUSEHOLD_SETTINGS[name] for name in names})


def household_holdout(spark: SparkSession, d: str) -> DataFrame:
    """The three household models scored on the rows they were not fitted on."""
    split, fitted = _household_models(spark, d, "gbt", "tree", "forest")
    scored = fitted.score(split.filter("split = 'test'"))
    return rounded(op.metric_table(scored, fitted.predictions(), "energy_consumption"))


def score_scenarios(spark: SparkSession, d: str) -> DataFrame:
    """What if it were five degrees warmer? Every plausible reading, scored anew."""
    clean, fitted = _household_models(spark, d, "tree")
    scenarios = clean.select(
        "event_id",
        "appliance_type",
        (F.col("outdoor_temperature") + 5).alias("outdoor_temperature"),
        "season",
        "household_size",
        "hour",
        "month",
        "day_of_week",
    )
    averages = written_once(op.average_by(clean), "averages")
    return rounded(op.score_scenarios(fitted.pipeline("tree"), scenarios, averages))


def scenario_keys(spark: SparkSession, d: str) -> DataFrame:
    """Scored scenarios without what depends on the tree."""
    scored = score_scenarios(spark, d)
    return scored.select("event_id", "appliance_type", "group_average", F.col("prediction").isNull().alias("missing"))


# --- models with an exact result ---------------------------------------------


def linear_one_feature(spark: SparkSession, d: str) -> DataFrame:
    """The forecast's linear model on one feature is the least-squares line."""
    series, train = split_and_training(spark, d)
    steps, model = fit_regressor(train, [assembler(["lag_24"])], "consumption", "linear", FORECAST_SETTINGS["linear"])
    scored = model.transform(steps.transform(series.filter("split <> 'train'")))
    return rounded(scored.select("home_id", "ts", "split", "prediction"), 5)


def model_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The same line from a model that was saved and loaded, scoring raw features."""
    series, train = split_and_training(spark, d)
    steps, model = fit_regressor(train, [assembler(["lag_24"])], "consumption", "linear", FORECAST_SETTINGS["linear"])
    path = _new_folder(spark, "model")
    save_model(PipelineModel([*steps.stages, model]), path)
    scored = load_model(path).transform(series.filter("split <> 'train'"))
    return rounded(scored.select("home_id", "ts", "split", "prediction"), 5)


def tree_on_hour(spark: SparkSession, d: str) -> DataFrame:
    """A tree of depth 1 on the hour predicts one of two training means: those on both sides
    of the hour that parts the training rows best."""
    series, train = split_and_training(spark, d)
    settings = {**HOUSEHOLD_SETTINGS["tree"], "maxDepth": 1}
    steps, model = fit_regressor(train, [assembler(["hour"])], "consumption", "tree", settings)
    scored = model.transform(steps.transform(series.filter("split <> 'train'")))
    return rounded(scored.select("home_id", "ts", "split", "prediction"), 5)


def by_appliance_model(name: str) -> Callable:
    """A tree model on the appliance alone, with full settings, predicts the training mean of
    each appliance; the forest does so without resampling its rows."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        stored = written_once(plausible(spark, d), "clean")
        train = op.spread(stored, ["event_id"])
        indexer = category_indexer({"appliance_type": "appliance_index"})
        settings = {**HOUSEHOLD_SETTINGS[name], **({"bootstrap": False} if name == "forest" else {})}
        steps, model = fit_regressor(
            train, [indexer, assembler(["appliance_index"])], "energy_consumption", name, settings
        )
        scored = model.transform(steps.transform(stored))
        return rounded(scored.groupBy("appliance_type").agg(F.min("prediction").alias("low"), F.max("prediction").alias("high")), 5)

    return query


def _checks(scored: DataFrame, train: DataFrame, label: str, models: dict[str, str]) -> DataFrame:
    """Per model: rows scored, predictions missing, and, for trees, outside the training labels."""
    ends = train.agg(F.min(label).alias("low"), F.max(label).alias("high")).select(F.struct("low", "high").alias("ends")).scalar()
    parts = [
        F.struct(F.lit(name).alias("model"), F.col(column).alias("prediction"), F.lit(name in ("tree", "forest")).alias("bounded"))
        for name, column in models.items()
    ]
    outside = F.col("bounded") & ((F.col("prediction") < ends["low"] - 1e-9) | (F.col("prediction") > ends["high"] + 1e-9))
    return (
        scored.select(F.inline(F.array(*parts)))
        .groupBy("model")
        .agg(
            F.count(F.lit(1)).alias("rows_scored"),
            F.count_if(F.col("prediction").isNull()).alias("missing"),
            F.count_if(outside).alias("outside"),
        )
    )


def forecast_checks(spark: SparkSession, d: str) -> DataFrame:
    series, train = split_and_training(spark, d)
    fitted = op.fit_forecast(train)
    scored = fitted.score(series.filter("split <> 'train'"))
    return _checks(scored, train, "consumption", fitted.predictions())


def household_checks(spark: SparkSession, d: str) -> DataFrame:
    split, fitted = _household_models(spark, d, "gbt", "tree", "forest")
    scored = fitted.score(split.filter("split = 'test'"))
    return _checks(scored, split.filter("split = 'train'"), "energy_consumption", fitted.predictions())


# --- sources and sinks -------------------------------------------------------


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/hearthwatt-{name}-{uuid.uuid4().hex}"


def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The untidy export written as CSV and read with the declared schema. Blank ends of the
    time text and empty dates are what CSV doesn't keep."""
    path = _new_folder(spark, "csv")
    raw_readings(spark, d).write.option("header", True).csv(path)
    read = op.rename_readings(read_csv_readings(spark, path))
    return rounded(read.withColumns({"time": F.trim("time"), "date": F.nullif(F.col("date"), F.lit(""))}))


def parquet_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Readings written into folders by appliance and read back."""
    path, df = _new_folder(spark, "parquet"), readings(spark, d)
    write_parquet(df, path, partition_by=["appliance_type"], rebalance=True)
    return rounded(read_parquet(spark, path, df.schema))


def single_csv_sink(spark: SparkSession, d: str) -> DataFrame:
    path = _new_folder(spark, "single")
    write_single_csv(rounded(op.by_appliance(plausible(spark, d))), path)
    schema = "appliance_type string, count long, avg_consumption double, total_consumption double"
    return spark.read.schema(schema).option("header", True).csv(path)


def predictions_sink(spark: SparkSession, d: str) -> DataFrame:
    """The naive forecast of a day ago in the form that the forecast job stores."""
    path = _new_folder(spark, "predictions")
    scored = naive_forecast(spark, d).select("home_id", "ts", "label", F.col("lag_24").alias("prediction"))
    write_parquet(scored, path)
    return rounded(read_parquet(spark, path, scored.schema))


def typed_timestamps(spark: SparkSession, d: str) -> DataFrame:
    """Date and time columns that are timestamps already."""
    df = events(spark, d).select("event_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("date"), F.col("ts").alias("time"))
    return op.with_timestamp(df).select("event_id", "ts")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # scans, selection, cleaning
    "scan_parquet": events,
    "preview_rows": lambda s, d: rounded(preview_rows(readings(s, d), ["ts", "event_id"], 50)),
    "rename_readings": lambda s, d: rounded(op.rename_readings(raw_readings(s, d))),
    "project_series": lambda s, d: readings(s, d).select("home_id", "ts", "energy_consumption"),
    "cast_numeric": cast_numeric,
    "filter_outliers": lambda s, d: op.keep_open_range(
        events(s, d).select("event_id", "value"), "value", 0, 20
    ),
    "filter_parsed_ts": filter_parsed_ts,
    "quality_report": quality_report,
    "stage_counts": stage_counts,
    "drop_any_null": lambda s, d: rounded(op.drop_nulls(op.rename_readings(raw_readings(s, d)))),
    "drop_null_features": drop_null_features,
    "dedup_rows": lambda s, d: op.drop_repeats(twice(op.rename_readings(raw_readings(s, d)))),
    "clean_readings": lambda s, d: op.clean_readings(twice(raw_readings(s, d))),
    "clean_readings_strict": lambda s, d: op.clean_readings(
        twice(raw_readings(s, d)), require_calendar=True
    ),
    "clean_by_hour": lambda s, d: rounded(op.by_hour(op.clean_readings(raw_readings(s, d)))),
    # samples and splits
    "sample_hash": lambda s, d: op.hash_sample(events(s, d), ["event_id"], 0.1).select(
        "event_id", "value"
    ),
    "scatter_feed": lambda s, d: op.hash_sample(plausible(s, d), ["event_id"], 0.01).select(
        "outdoor_temperature", "hour", "energy_consumption"
    ),
    "split_hash": lambda s, d: op.hash_split(events(s, d), ["event_id"]).select("event_id", "split"),
    "split_by_time": split_by_time,
    "split_sizes": split_sizes,
    "time_bounds": lambda s, d: op.time_bounds(readings(s, d)),
    # reports
    "by_appliance": _report(op.by_appliance),
    "by_season": _report(op.by_season),
    "by_hour": _report(op.by_hour),
    "by_household_size": _report(op.by_household_size),
    "by_date_hour": _report(op.by_date_hour),
    "by_date_hour_first": _report(lambda df: op.by_date_hour(df, n=100)),
    "profile_all": _report(op.profile_all),
    "headline": _report(op.headline),
    "describe_numeric": _report(op.describe_numeric),
    "correlation": _report(op.correlation),
    "histogram": _report(op.histogram),
    "season_share": _report(op.season_share),
    "compare_to_average": compare_to_average,
    # parsing and calendar
    "parse_hour": parse_hour,
    "parse_date": parse_date_query,
    "calendar_parts": calendar_query,
    "build_timestamp": build_timestamp,
    "interaction_terms": lambda s, d: op.interaction_terms(
        readings(s, d).select("event_id", "outdoor_temperature")
    ),
    # series
    "hourly_rollup": lambda s, d: rounded(hourly(s, d)),
    "lag_features": _series(),
    "lag_features_time": _series(by="time"),
    "rolling_features": _rolling(),
    "rolling_features_prior": _rolling(include_current=False),
    "rolling_features_time": _rolling(by="time"),
    "featured_orders": featured_orders,
    # model inputs and metrics
    "index_categories": index_categories,
    "scale_std": scale_query(center=False),
    "scale_zscore": scale_query(center=True),
    "fitted_features": fitted_features,
    "metric_suite": metric_suite,
    "metric_mape": metric_mape,
    "metric_table": metric_table,
    "best_model": best_model,
    # sources and sinks
    "csv_round_trip": csv_round_trip,
    "parquet_round_trip": parquet_round_trip,
    "single_csv_sink": single_csv_sink,
    "predictions_sink": predictions_sink,
    "typed_timestamps": typed_timestamps,
    # models with an exact result
    "linear_one_feature": linear_one_feature,
    "model_round_trip": model_round_trip,
    "tree_on_hour": tree_on_hour,
    "tree_by_appliance": by_appliance_model("tree"),
    "gbt_by_appliance": by_appliance_model("gbt"),
    "forest_by_appliance": by_appliance_model("forest"),
    "forecast_checks": forecast_checks,
    "household_checks": household_checks,
    "forecast_preview_keys": lambda s, d: forecast_preview(s, d).drop("prediction"),
    "scenario_keys": scenario_keys,
    # models (no SQL twin)
    "forecast_linear": _forecast("linear"),
    "forecast_tree": _forecast("tree"),
    "forecast_forest": _forecast("forest"),
    "forecast_gbt": _forecast("gbt"),
    "forecast_holdout": forecast_holdout,
    "forecast_preview": forecast_preview,
    "household_holdout": household_holdout,
    "score_scenarios": score_scenarios,
}

