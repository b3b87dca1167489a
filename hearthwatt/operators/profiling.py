"""Consumption reports over clean readings.

All of them aggregate inside each task first, so what is shuffled is one row per
task and group, however many readings a group holds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_width_bin, number

ENERGY = "energy_consumption"
TEMPERATURE = "outdoor_temperature"

# The columns of the statistics table and of the correlation matrix.
DESCRIBED = (ENERGY, TEMPERATURE, "household_size")
CORRELATED = (ENERGY, TEMPERATURE, "household_size", "hour", "month")


def by_appliance(df: DataFrame) -> DataFrame:
    """Readings, mean and total energy per appliance; largest total first."""
    return (
        df.groupBy("appliance_type")
        .agg(
            F.count(ENERGY).alias("count"),
            F.avg(ENERGY).alias("avg_consumption"),
            F.sum(ENERGY).alias("total_consumption"),
        )
        .orderBy(F.desc("total_consumption"), "appliance_type")
    )


def by_season(df: DataFrame) -> DataFrame:
    """Readings, mean energy and mean temperature per season; highest mean first."""
    return (
        df.groupBy("season")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg(ENERGY).alias("avg_consumption"),
            F.avg(TEMPERATURE).alias("avg_temperature"),
        )
        .orderBy(F.desc("avg_consumption"), "season")
    )


def by_hour(df: DataFrame) -> DataFrame:
    """Mean energy per hour of day."""
    return df.groupBy("hour").agg(F.avg(ENERGY).alias("avg_consumption")).orderBy("hour")


def by_household_size(df: DataFrame) -> DataFrame:
    """Readings and mean energy per household size."""
    return (
        df.groupBy("household_size")
        .agg(F.count(F.lit(1)).alias("count"), F.avg(ENERGY).alias("avg_consumption"))
        .orderBy("household_size")
    )


def by_date_hour(df: DataFrame, n: int | None = None) -> DataFrame:
    """Mean energy per date and hour, in order; with ``n`` the first points only."""
    means = df.groupBy("date", "hour").agg(F.avg(ENERGY).alias("avg_consumption"))
    line = means.orderBy("date", "hour")
    return line if n is None else line.limit(n)


def profile_all(df: DataFrame) -> DataFrame:
    """The appliance, season, hour and household-size reports from one scan.

    Long form ``(dimension, value, count, avg_consumption, total_consumption,
    avg_temperature)``. Readings are summed per combination of the four first, so
    the grouping sets unfold combinations, not readings.
    """
    dimensions = ("appliance_type", "season", "hour", "household_size")
    combined = df.groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(ENERGY).alias("energy"),
        F.count(ENERGY).alias("n_energy"),
        F.sum(TEMPERATURE).alias("temperature"),
        F.count(TEMPERATURE).alias("n_temperature"),
    )

    def of_set(part: Callable[[str], Column]) -> Column:
        return F.coalesce(*(F.when(F.grouping(d) == 0, part(d)) for d in dimensions))

    return (
        combined.groupingSets([[F.col(d)] for d in dimensions], *map(F.col, dimensions))
        .agg(
            of_set(F.lit).alias("dimension"),
            of_set(lambda d: F.col(d).cast("string")).alias("value"),
            F.sum("n").alias("count"),
            F.try_divide(F.sum("energy"), F.sum("n_energy")).alias("avg_consumption"),
            F.sum("energy").alias("total_consumption"),
            F.try_divide(F.sum("temperature"), F.sum("n_temperature")).alias("avg_temperature"),
        )
        .drop(*dimensions)
    )


def from_profile(profile: DataFrame, dimension: str) -> DataFrame:
    """One of the four reports, sorted, from a stored ``profile_all``: no further scan.

    Its ``count`` is that of rows, which is also that of energies in a clean table.
    """
    kinds = {"hour": "int", "household_size": "int"}
    part = profile.filter(F.col("dimension") == dimension).withColumn(
        dimension, F.col("value").cast(kinds.get(dimension, "string"))
    )
    figures, order = {
        "appliance_type": (("count", "avg_consumption", "total_consumption"), F.desc("total_consumption")),
        "season": (("count", "avg_consumption", "avg_temperature"), F.desc("avg_consumption")),
        "hour": (("avg_consumption",), F.col("hour")),
        "household_size": (("count", "avg_consumption"), F.col("household_size")),
    }[dimension]
    return part.select(dimension, *figures).orderBy(order, dimension)


def headline(df: DataFrame) -> DataFrame:
    """The four headline figures in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.avg(ENERGY).alias("avg_consumption"),
        F.count_distinct("appliance_type").alias("unique_appliances"),
        F.avg("household_size").alias("avg_household_size"),
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] = DESCRIBED) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column, as numbers."""

    def figures(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("column"),
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("stddev"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )

    return df.agg(F.array(*map(figures, columns)).alias("figures")).select(F.inline("figures"))


# Spark compiles an aggregation as a whole up to 100 buffer fields and is some ten
# times slower beyond. A pair takes ten fields.
_PAIRS_PER_PASS = 10


def correlation(df: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """Pearson correlation of every two columns, as rows ``(x, y, r)``.

    Each pair uses the rows where both columns have a value. A column that does not
    vary has no correlation: ``r`` is NULL; for the diagonal, one that does not vary in
    the rows of any pair. Ten pairs, so those of five columns, share one pass over the
    columns they need, and the diagonal follows from their deviations.
    """
    pairs = list(combinations(columns, 2))
    passes = [pairs[k : k + _PAIRS_PER_PASS] for k in range(0, len(pairs), _PAIRS_PER_PASS)]
    cells = None
    for some in passes or [[(columns[0], columns[0])]]:
        figures = []
        for x, y in some:
            a, b = number(F.col(x)), number(F.col(y))
            dev_x = F.stddev_samp(F.when(b.isNotNull(), a))
            dev_y = F.stddev_samp(F.when(a.isNotNull(), b))
            r = F.try_divide(F.covar_samp(a, b), dev_x * dev_y)
            own = [(x, x, F.when(dev_x > 0, F.lit(1.0))), (y, y, F.when(dev_y > 0, F.lit(1.0)))]
            both = [(x, y, r), (y, x, r)] if x != y else []
            figures += [
                F.struct(F.lit(i).alias("x"), F.lit(j).alias("y"), value.alias("r")) for i, j, value in own + both
            ]
        part = df.agg(F.array(*figures).alias("cells")).select(F.inline("cells"))
        cells = part if cells is None else cells.unionByName(part)
    return cells.groupBy("x", "y").agg(F.max("r").alias("r"))


def histogram(
    df: DataFrame, column: str = ENERGY, width: float = 0.4, scale: int = 100
) -> DataFrame:
    """Readings per fixed-width bin, over all rows: ``(bin, bin_start, count)``."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(fixed_width_bin(F.col(column), width, scale).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select("bin", (F.col("bin") * F.lit(width)).alias("bin_start"), "count")
        .orderBy("bin")
    )


def season_share(df: DataFrame) -> DataFrame:
    """Share of readings per season.

    The total is a scalar subquery over the same counts; Spark runs the counting
    once and reuses its exchange, and no single task sees all groups.
    """
    counts = df.groupBy("season").agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.withColumn("share", F.col("count") / total)


def average_by(df: DataFrame, key: str = "appliance_type", value: str = ENERGY) -> DataFrame:
    """Mean of ``value`` per key: ``(key, group_average)``."""
    return df.groupBy(key).agg(F.avg(value).alias("group_average"))
