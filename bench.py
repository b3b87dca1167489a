"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of local cores and
``BENCH_SHARED_DIR`` the folder for checkpoints and stored tables (default: the session's
warehouse). Relational queries are timed as the best of three runs into a sink that discards
rows; model fits and whole jobs run once, with the library's full settings and defaults.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hearthwatt import operators as op  # noqa: E402
from hearthwatt.operators.modelling import FORECAST_SETTINGS, HOUSEHOLD_SETTINGS  # noqa: E402
from hearthwatt.plans.catalogue import QUERIES, raw_readings, readings, split_series  # noqa: E402
from hearthwatt.plans.forecast import run_forecast  # noqa: E402
from hearthwatt.plans.household import run_household  # noqa: E402
from hearthwatt.sources import delete_written, shared_folder, written_once  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SHARED_DIR = os.environ.get("BENCH_SHARED_DIR")

RELATIONAL = (
    "by_appliance",
    "profile_all",
    "correlation",
    "clean_readings",
    "hourly_rollup",
    "lag_features",
    "rolling_features",
    "drop_null_features",
    "split_by_time",
    "metric_table",
    "compare_to_average",
)


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("hearthwatt-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if SHARED_DIR:
        builder = builder.config("spark.checkpoint.dir", SHARED_DIR)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # As on a cluster: long boosting runs cut their lineage here.
    spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/hearthwatt-checkpoints")
    return spark


def seconds(work: Callable[[], object]) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def household_training_rows(spark: SparkSession) -> DataFrame:
    """All readings, without the outlier filter, so that the fits see every row."""
    df = readings(spark, SF_DIR).selectExpr(
        "*", "hour(ts) AS hour", "month(ts) AS month", "dayofweek(ts) AS day_of_week"
    )
    stored = written_once(op.hash_split(df, ["event_id"], portable=False), "bench")
    return op.spread(stored.filter("split = 'train'"), ["event_id"])


def main() -> None:
    spark = session()
    times = {
        name: min(seconds(lambda: discard(QUERIES[name](spark, SF_DIR))) for _ in range(3))
        for name in RELATIONAL
    }

    train = household_training_rows(spark)
    times["fit_household_forest"] = seconds(
        lambda: op.fit_household(train, {"forest": HOUSEHOLD_SETTINGS["forest"]})
    )
    times["fit_household_all"] = seconds(lambda: op.fit_household(train, parallelism=3))
    series = split_series(spark, SF_DIR).filter("split = 'train'")
    rows = op.spread(series, ["home_id", "ts"])
    times["fit_forecast_linear"] = seconds(
        lambda: op.fit_forecast(rows, {"linear": FORECAST_SETTINGS["linear"]})
    )

    folder = f"{shared_folder(spark)}/hearthwatt-bench-{uuid.uuid4().hex}"
    raw_readings(spark, SF_DIR).write.parquet(f"{folder}/raw")
    both = ("yyyy-MM-dd", "dd/MM/yyyy")
    times["job_forecast"] = seconds(
        lambda: run_forecast(spark, f"{folder}/raw", f"{folder}/forecast", date_formats=both)
    )
    times["job_household"] = seconds(
        lambda: run_household(spark, f"{folder}/raw", f"{folder}/household", "parquet", date_formats=both)
    )
    delete_written(spark)

    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rsplit("/sf", 1)[-1],
        "cpus": CPUS,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
