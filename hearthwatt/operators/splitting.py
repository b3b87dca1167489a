"""Repeatable samples and train/validation/test splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions import epoch_seconds, in_first_share


def hash_sample(
    df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42, portable: bool = True
) -> DataFrame:
    """A fixed share of the rows, chosen by key: the same rows on every run."""
    return df.filter(in_first_share(fraction, *keys, seed=seed, portable=portable))


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    shares: Mapping[str, float] | None = None,
    seed: int = 42,
    portable: bool = True,
) -> DataFrame:
    """Adds ``split``, drawn by key with the given shares (default 80/20)."""
    shares = shares or {"train": 0.8, "test": 0.2}
    if abs(sum(shares.values()) - 1) > 1e-9:
        raise ValueError("shares must add up to 1")
    *earlier, last = shares
    ends = accumulate(shares[name] for name in earlier)
    drawn = (
        F.when(in_first_share(end, *keys, seed=seed, portable=portable), name)
        for name, end in zip(earlier, ends)
    )
    return df.withColumn("split", F.coalesce(*drawn, F.lit(last)))


def time_bounds(df: DataFrame, ts: str = "ts") -> DataFrame:
    """First and last timestamp in one row."""
    return df.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def time_limits(
    df: DataFrame, cuts: tuple[float, float] = (0.8, 0.9), ts: str = "ts"
) -> DataFrame:
    """Last second of the training and of the validation part, in one row.

    ``cuts`` are shares of the range between the first and last timestamp.
    """
    seconds = epoch_seconds(F.col(ts))
    bounds = df.agg(F.min(seconds).alias("first"), F.max(seconds).alias("last"))
    first, last = F.col("first"), F.col("last")
    train_end, val_end = (F.floor(first + (last - first) * F.lit(cut)) for cut in cuts)
    return bounds.select(train_end.alias("train_end"), val_end.alias("val_end"))


def split_by_time(
    df: DataFrame,
    cuts: tuple[float, float] = (0.8, 0.9),
    ts: str = "ts",
    limits: Mapping[str, int] | Row | None = None,
) -> DataFrame:
    """Adds ``split``: ``train``, ``val`` or ``test`` by position in the time range.

    A row on a cut belongs to the earlier part. The limits are computed by Spark, in
    the same clock as the rows, and reach them as a one-row scalar subquery. Where
    many actions follow, pass the row of ``time_limits`` to compute them only once; so
    too where ``df`` has window functions, which the subquery would run again.
    """
    seconds = epoch_seconds(F.col(ts))
    if limits is None:
        ends = time_limits(df, cuts, ts).select(F.struct("train_end", "val_end").alias("ends")).scalar()
        train_end, val_end = ends["train_end"], ends["val_end"]
    else:
        train_end, val_end = F.lit(limits["train_end"]), F.lit(limits["val_end"])
    return df.withColumn(
        "split",
        F.when(seconds <= train_end, "train").when(seconds <= val_end, "val").otherwise("test"),
    )


def within_split(split: str, limits: Mapping[str, int] | Row, ts: str = "ts") -> Column:
    """The rows of one part as a range of ``ts`` between literals, which a scan can skip by."""

    def after(second: int) -> Column:
        moment = datetime(1970, 1, 1) + timedelta(seconds=second + 1)
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")

    train_end, val_end = after(limits["train_end"]), after(limits["val_end"])
    return {
        "train": F.col(ts) < train_end,
        "val": (F.col(ts) >= train_end) & (F.col(ts) < val_end),
        "test": F.col(ts) >= val_end,
    }[split]


def split_ranges(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows and first and last timestamp per split, in one job."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")
    )


def split_sizes(df: DataFrame) -> DataFrame:
    """Rows per split, in one job."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
