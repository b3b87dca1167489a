"""The shape of the plans, and results that do not depend on partitioning."""

import pytest
from pyspark.sql import functions as F

from compare import spark_result
from hearthwatt import operators as op
from hearthwatt.plans import catalogue
from hearthwatt.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(catalogue.QUERIES[name](spark, SF_DIR))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_features_need_one_sort_and_no_range_exchange(spark):
    text = plan(op.featured_series(catalogue.hourly(spark, SF_DIR)))
    assert text.count("Window [") == 1
    assert text.count("Sort [") == 1
    assert text.count("Exchange hashpartitioning") == 2
    assert "rangepartitioning" not in text


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(op.by_appliance(catalogue.plausible(spark, SF_DIR)))
    assert "GreaterThan(value,0.0)" in text and "LessThan(value,20.0)" in text
    assert "ReadSchema: struct<event_type:string,value:double>" in text


def test_outlier_filter_runs_before_the_duplicate_removal(spark):
    raw = catalogue.raw_readings(spark, SF_DIR)
    text = plan(op.clean_readings(raw))
    assert "GreaterThan(value,0.0)" in text
    assert text.count("Exchange") == 1


def test_limits_do_not_sort_the_table(spark):
    assert "TakeOrderedAndProject" in plan(catalogue.QUERIES["preview_rows"](spark, SF_DIR))


def test_correlation_is_compiled(spark):
    df = op.correlation(catalogue.plausible(spark, SF_DIR))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    aggregates = [line for line in final.splitlines() if "HashAggregate" in line]
    assert aggregates and all("*(" in line for line in aggregates)


def test_stored_averages_are_broadcast_without_shuffling_the_scored_rows(spark):
    text = plan(catalogue.QUERIES["compare_to_average"](spark, SF_DIR))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_large_averages_are_joined_by_shuffle(spark):
    averages = spark.range(1000).selectExpr("cast(id as string) appliance_type", "1D group_average")
    scored = spark.range(1000).selectExpr("cast(id as string) appliance_type", "2D prediction")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = op.compare_to_average(scored, averages)
        assert "SortMergeJoin" in plan(joined)
        assert joined.filter("percent_difference = 100").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


INVARIANT = {
    "by_appliance": op.by_appliance,
    "profile_all": op.profile_all,
    "headline": op.headline,
    "correlation": op.correlation,
    "histogram": op.histogram,
    "season_share": op.season_share,
    "sample": lambda df: op.hash_sample(df, ["event_id"], 0.3).select("event_id"),
    "rollup": op.hourly_rollup,
    "features": lambda df: op.featured_series(op.hourly_rollup(df)),
    "split": lambda df: op.split_sizes(op.split_by_time(op.hourly_rollup(df))),
    "metrics": lambda df: op.metric_suite(
        op.featured_series(op.hourly_rollup(df)).withColumn("label", F.col("consumption")), "label", "lag_1"
    ).drop("mape"),
}


@pytest.mark.parametrize("name", sorted(INVARIANT))
def test_same_result_for_any_partitioning(spark, name):
    df = catalogue.plausible(spark, SF_DIR)
    if name in ("features", "metrics"):
        df = catalogue.readings(spark, SF_DIR)
    results = [
        spark_result(catalogue.rounded(INVARIANT[name](df.repartition(parts)))) for parts in (1, 4, 16)
    ]
    assert results[0] == results[1] == results[2]


def test_correlation_reads_the_table_once(spark):
    assert plan(catalogue.QUERIES["correlation"](spark, SF_DIR)).count("FileScan") == 1


def test_metric_table_runs_its_windows_once(spark):
    assert plan(catalogue.QUERIES["metric_table"](spark, SF_DIR)).count("Window [") <= 1


def test_training_rows_of_the_forecast_are_a_pushed_range(spark, tmp_path):
    stored = catalogue.written_once(catalogue.hourly(spark, SF_DIR), "series", str(tmp_path / "series"))
    limits = op.time_limits(stored).first()
    train = stored.filter(op.within_split("train", limits))
    assert "LessThan(ts," in plan(train)
    split = op.split_by_time(stored, limits=limits)
    for name in ("train", "val", "test"):
        assert stored.filter(op.within_split(name, limits)).count() == split.filter(f"split = '{name}'").count()


def test_training_rows_of_the_household_are_a_folder(spark, tmp_path):
    drawn = op.hash_split(catalogue.plausible(spark, SF_DIR), ["event_id"])
    drawn.write.partitionBy("split").parquet(str(tmp_path / "split"))
    train = spark.read.parquet(str(tmp_path / "split")).filter("split = 'train'")
    assert "PartitionFilters: [isnotnull(split" in plan(train)


def test_rows_featured_are_the_rows_kept(spark):
    raw = catalogue.gappy_readings(spark, SF_DIR)
    stamped = op.timestamped_readings(raw, catalogue.BOTH_DATE_FORMATS)
    hourly = op.hourly_rollup(stamped, count_as="readings")
    counts = op.stage_counts(raw, op.featured_series(hourly, required=None)).first()
    assert counts["rows_featured"] == op.featured_series(hourly).count()
