"""Job: hourly consumption forecast, from raw readings to a chosen and saved model.

    python -m hearthwatt.plans.forecast SOURCE OUTPUT

Written under the output folder: ``features``, ``holdout``, ``metrics``,
``metrics_summary`` (one CSV file), ``quality``, ``splits`` (rows and time range of
each part), ``models/<best>``, ``predictions``.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import ISO_DATE
from ..operators import (
    best_model_name,
    featured_series,
    fit_forecast,
    hourly_rollup,
    metric_table,
    save_model,
    split_by_time,
    split_ranges,
    spread,
    stage_counts,
    time_limits,
    timestamped_readings,
    within_split,
)
from ..operators.modelling import FORECAST_SETTINGS, TRAINING_PARTITIONS
from ..operators.series import FEATURES, LABEL
from ..schema import METRICS_SUMMARY
from ..sources import read_parquet, write_parquet, write_single_csv
from .running import add_job_arguments, job_session, needs_checkpoints


def run_forecast(
    spark: SparkSession,
    source: str,
    output: str,
    settings: Mapping[str, Mapping] = FORECAST_SETTINGS,
    by: str = "rows",
    include_current: bool = False,
    date_formats: Sequence[str] = (ISO_DATE,),
    parallelism: int = 1,
    training_partitions: int = TRAINING_PARTITIONS,
) -> str:
    """Runs the whole forecast and returns the name of the chosen model.

    The featured hourly table is written once; counts, bounds, fits and scoring read
    it. Raw readings are read for it, and once more, without columns, to count them.
    Training rows are a range of timestamps, which the scan skips by. The table keeps the hours that lack a
    feature and the number of readings per hour, from which the rows after each stage
    are counted. ``include_current=True`` lets the rolling features see the hour to be
    forecast; it is off, and the metrics table says which was used.
    """
    needs_checkpoints(spark, settings)
    raw = read_parquet(spark, source)
    hourly = hourly_rollup(timestamped_readings(raw, date_formats), count_as="readings")
    featured = featured_series(hourly, by, include_current, required=None)
    write_parquet(featured, f"{output}/features")
    stored = read_parquet(spark, f"{output}/features", featured.schema)
    required = (LABEL, *FEATURES)
    write_parquet(stage_counts(raw, stored, required), f"{output}/quality")

    usable = stored.dropna(subset=list(required))
    limits = time_limits(usable).first()
    series = split_by_time(usable, limits=limits)
    write_parquet(split_ranges(series), f"{output}/splits")
    train = spread(usable.filter(within_split("train", limits)), ["home_id", "ts"], training_partitions)
    fitted = fit_forecast(train, settings, parallelism=parallelism)

    scored = fitted.score(series.filter(~within_split("train", limits)))
    columns = fitted.predictions()
    holdout = scored.select("home_id", "ts", F.col(LABEL).alias("label"), *columns.values(), "split")
    write_parquet(holdout, f"{output}/holdout", partition_by=["split"])

    stored = read_parquet(spark, f"{output}/holdout", holdout.schema)
    metrics = metric_table(stored, columns, by=["split"]).withColumns(
        {"features_by": F.lit(by), "features_include_current": F.lit(include_current)}
    )
    write_parquet(metrics, f"{output}/metrics")
    metrics = read_parquet(spark, f"{output}/metrics", metrics.schema)
    best = best_model_name(metrics.filter("split = 'val'"), "rmse")

    write_single_csv(metrics_summary(metrics, best), f"{output}/metrics_summary")
    save_model(fitted.pipeline(best), f"{output}/models/{best}")
    predictions = stored.filter("split = 'test'").select(
        "home_id", "ts", "label", F.col(columns[best]).alias("prediction")
    )
    write_parquet(predictions, f"{output}/predictions")
    return best


def metrics_summary(metrics: DataFrame, model: str) -> DataFrame:
    """Validation and test figures of one model in one row."""
    chosen = metrics.filter(F.col("model") == model)
    figures = [
        F.max(F.when(F.col("split") == split, F.col(metric))).alias(f"{split}_{metric}")
        for split in ("val", "test")
        for metric in ("rmse", "mae", "mape")
    ]
    return chosen.groupBy("model").agg(*figures).select(METRICS_SUMMARY.fieldNames())


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Hourly consumption forecast")
    parser.add_argument("source", help="Parquet folder of raw readings")
    parser.add_argument("output")
    parser.add_argument("--by", choices=("rows", "time"), default="rows")
    parser.add_argument("--include-current", action="store_true")
    parser.add_argument("--date-format", action="append", dest="date_formats")
    add_job_arguments(parser)
    args = parser.parse_args(argv)
    spark = job_session("hearthwatt-forecast", args.checkpoint_dir)
    best = run_forecast(
        spark,
        args.source,
        args.output,
        by=args.by,
        include_current=args.include_current,
        date_formats=args.date_formats or (ISO_DATE,),
        parallelism=args.parallelism,
        training_partitions=args.training_partitions,
    )
    print(f"chosen model: {best}")


if __name__ == "__main__":
    main()
