"""Job: household consumption reports, appliance models and scenario scoring.

    python -m hearthwatt.plans.household SOURCE OUTPUT [--format csv|parquet]

Written under the output folder: ``clean``, ``quality``, ``schema``,
``reports/<name>``, ``averages``, ``split`` (by split), ``holdout``, ``metrics``, ``models/<name>`` and,
where scenarios are given, ``scenarios``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import ISO_DATE
from ..operators import (
    best_model_name,
    by_date_hour,
    clean_readings,
    correlation,
    describe_numeric,
    fit_household,
    from_profile,
    hash_sample,
    hash_split,
    headline,
    histogram,
    load_model,
    metric_table,
    profile_all,
    quality_report,
    save_model,
    score_scenarios,
    spread,
)
from ..operators.modelling import HOUSEHOLD_NUMBERS, HOUSEHOLD_SETTINGS, TRAINING_PARTITIONS
from ..operators.profiling import ENERGY
from ..schema import READING_NAMES, SCENARIO
from ..sources import (
    preview_rows,
    read_csv_readings,
    read_parquet,
    schema_report,
    write_parquet,
)
from .running import add_job_arguments, job_session, needs_checkpoints

# What identifies a clean reading: all stored columns, as repeats are removed.
KEYS = tuple(READING_NAMES.values())

# One percent of the points is enough to draw them.
SCATTER_SHARE = 0.01

REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "headline": headline,
    "describe": describe_numeric,
    "by_date_hour": by_date_hour,
    "correlation": correlation,
    "histogram": histogram,
    "scatter": lambda df: hash_sample(df, KEYS, SCATTER_SHARE, portable=False).select(
        "outdoor_temperature", "hour", ENERGY
    ),
    "preview": lambda df: preview_rows(df, KEYS),
}


# The reports that follow from the profile, and their dimension in it.
PROFILED = {
    "by_appliance": "appliance_type",
    "by_season": "season",
    "by_hour": "hour",
    "by_household_size": "household_size",
}


def clean_table(
    spark: SparkSession,
    source: str,
    output: str,
    file_format: str,
    date_formats: Sequence[str] = (ISO_DATE,),
) -> DataFrame:
    """Cleans the source once and returns the stored clean table."""
    read = read_csv_readings if file_format == "csv" else read_parquet
    raw = read(spark, source)
    write_parquet(quality_report(raw, date_formats=date_formats), f"{output}/quality")
    clean = clean_readings(raw, date_formats=date_formats)
    write_parquet(clean, f"{output}/clean")
    write_parquet(schema_report(clean), f"{output}/schema")
    return read_parquet(spark, f"{output}/clean", clean.schema)


def write_reports(clean: DataFrame, output: str) -> None:
    """Every report. Each scan of the clean table reads only the columns it needs; the
    reports per appliance, season, hour and household size follow from the stored profile."""
    for name, report in REPORTS.items():
        write_parquet(report(clean), f"{output}/reports/{name}")
    write_parquet(profile_all(clean), f"{output}/reports/profile")
    profile = read_parquet(clean.sparkSession, f"{output}/reports/profile")
    for name, dimension in PROFILED.items():
        write_parquet(from_profile(profile, dimension), f"{output}/reports/{name}")
    seasons, appliances = (profile.filter(F.col("dimension") == d) for d in ("season", "appliance_type"))
    total = seasons.agg(F.sum("count").alias("total")).scalar()
    share = seasons.select(F.col("value").alias("season"), "count", (F.col("count") / total).alias("share"))
    write_parquet(share, f"{output}/reports/season_share")
    averages = appliances.select(
        F.col("value").alias("appliance_type"), F.col("avg_consumption").alias("group_average")
    )
    write_parquet(averages, f"{output}/averages")


def train_models(
    clean: DataFrame,
    output: str,
    settings: Mapping[str, Mapping] = HOUSEHOLD_SETTINGS,
    parallelism: int = 1,
    training_partitions: int = TRAINING_PARTITIONS,
) -> str:
    """Fits, scores and saves the models; returns the one with the highest test R2.

    The split is drawn once and stored as folders, so each fit reads the training rows alone.
    """
    spark = clean.sparkSession
    needs_checkpoints(spark, settings)
    drawn = hash_split(clean.dropna(subset=[ENERGY, *HOUSEHOLD_NUMBERS]), KEYS, portable=False)
    write_parquet(drawn, f"{output}/split", partition_by=["split"])
    split = read_parquet(spark, f"{output}/split", drawn.schema)
    train = spread(split.filter("split = 'train'"), KEYS, training_partitions)
    fitted = fit_household(train, settings, parallelism=parallelism)
    columns = fitted.predictions()
    holdout = fitted.score(split.filter("split = 'test'")).select(
        *KEYS, F.col(ENERGY).alias("label"), *columns.values()
    )
    write_parquet(holdout, f"{output}/holdout")
    stored = read_parquet(spark, f"{output}/holdout", holdout.schema)
    metrics = metric_table(stored, columns)
    write_parquet(metrics, f"{output}/metrics")
    for name in fitted.regressors:
        save_model(fitted.pipeline(name), f"{output}/models/{name}")
    stored_metrics = read_parquet(spark, f"{output}/metrics", metrics.schema)
    return best_model_name(stored_metrics, "r2", largest=True)


def score_file(
    spark: SparkSession, scenarios: DataFrame, output: str, model: str
) -> DataFrame:
    """Scores scenarios with a saved model against the stored appliance averages."""
    averages = read_parquet(spark, f"{output}/averages")
    return score_scenarios(load_model(f"{output}/models/{model}"), scenarios, averages)


def run_household(
    spark: SparkSession,
    source: str,
    output: str,
    file_format: str = "csv",
    settings: Mapping[str, Mapping] = HOUSEHOLD_SETTINGS,
    scenarios: DataFrame | None = None,
    model: str | None = None,
    parallelism: int = 1,
    date_formats: Sequence[str] = (ISO_DATE,),
    training_partitions: int = TRAINING_PARTITIONS,
) -> str:
    """Cleans, reports, trains and scores; returns the best model's name.

    Scenarios are scored with ``model``, or with the best one if none is named.
    """
    clean = clean_table(spark, source, output, file_format, date_formats)
    write_reports(clean, output)
    best = train_models(clean, output, settings, parallelism, training_partitions)
    if scenarios is not None:
        write_parquet(score_file(spark, scenarios, output, model or best), f"{output}/scenarios")
    return best


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Household consumption reports and models")
    parser.add_argument("source")
    parser.add_argument("output")
    parser.add_argument("--format", choices=("csv", "parquet"), default="csv", dest="file_format")
    parser.add_argument("--scenarios", help="CSV file of scenarios with a header line")
    parser.add_argument("--model", choices=tuple(HOUSEHOLD_SETTINGS))
    parser.add_argument("--date-format", action="append", dest="date_formats")
    add_job_arguments(parser)
    args = parser.parse_args(argv)
    spark = job_session("hearthwatt-household", args.checkpoint_dir)
    scenarios = read_csv_readings(spark, args.scenarios, SCENARIO) if args.scenarios else None
    best = run_household(
        spark,
        args.source,
        args.output,
        args.file_format,
        scenarios=scenarios,
        model=args.model,
        parallelism=args.parallelism,
        date_formats=args.date_formats or (ISO_DATE,),
        training_partitions=args.training_partitions,
    )
    print(f"best model: {best}")


if __name__ == "__main__":
    main()
