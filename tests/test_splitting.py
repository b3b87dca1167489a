import pytest
from pyspark.sql import functions as F

from fixtures import series
from hearthwatt.operators import hash_sample, hash_split, split_by_time, split_sizes, time_bounds, time_limits


def test_split_by_time_cuts(spark):
    df = series(spark, {1: [(h, 1.0) for h in range(101)]})
    sizes = {r["split"]: r["rows"] for r in split_sizes(split_by_time(df)).collect()}
    # 0..80 (a row on the cut is train), 81..90, 91..100
    assert sizes == {"train": 81, "val": 10, "test": 10}


def test_limits_computed_beforehand_give_the_same_split(spark):
    df = series(spark, {1: [(h, 1.0) for h in range(101)], 2: [(h, 1.0) for h in range(40, 77)]})
    limits = time_limits(df, (0.5, 0.7)).first()
    assert split_by_time(df, (0.5, 0.7)).exceptAll(split_by_time(df, limits=limits)).isEmpty()


def test_split_by_time_of_one_moment(spark):
    df = series(spark, {1: [(0, 1.0)], 2: [(0, 2.0)]})
    assert {r["split"] for r in split_by_time(df).collect()} == {"train"}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_split_by_time_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = series(spark, {1: [(h, 1.0) for h in range(0, 24 * 200, 24)]})
        sizes = {r["split"]: r["rows"] for r in split_sizes(split_by_time(df)).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sizes == {"train": 160, "val": 20, "test": 20}


def test_time_bounds(spark):
    row = time_bounds(series(spark, {1: [(3, 1.0)], 2: [(1, 1.0), (7, 1.0)]})).first()
    assert (row["min_ts"].hour, row["max_ts"].hour) == (1, 7)


@pytest.mark.parametrize("portable", [True, False])
def test_hash_split_is_the_same_for_any_partitioning(spark, portable):
    df = spark.range(5000)

    def drawn(parts):
        split = hash_split(df.repartition(parts), ["id"], portable=portable)
        return {r["id"] for r in split.filter("split = 'train'").collect()}

    first = drawn(1)
    assert first == drawn(4) == drawn(16)
    assert abs(len(first) - 4000) < 150


def test_hash_split_of_three(spark):
    split = hash_split(spark.range(10000), ["id"], {"a": 0.5, "b": 0.3, "c": 0.2})
    sizes = {r["split"]: r["rows"] for r in split_sizes(split).collect()}
    assert sum(sizes.values()) == 10000
    assert all(abs(sizes[n] - s) < 250 for n, s in {"a": 5000, "b": 3000, "c": 2000}.items())
    with pytest.raises(ValueError):
        hash_split(spark.range(1), ["id"], {"a": 0.5, "b": 0.3})


def test_sample_follows_the_seed(spark):
    df = spark.range(1000)
    one, two = (
        {r["id"] for r in hash_sample(df, ["id"], 0.2, seed=s).collect()} for s in (1, 2)
    )
    assert one and two and one != two


def test_split_feeds_filters(spark):
    df = split_by_time(series(spark, {1: [(h, 1.0) for h in range(101)]}))
    assert df.filter(F.col("split") == "val").count() == 10
