"""Predictions set against what is usual for the appliance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import percent_difference


def compare_to_average(
    scored: DataFrame,
    averages: DataFrame,
    key: str = "appliance_type",
    prediction: str = "prediction",
) -> DataFrame:
    """Adds ``group_average`` and ``percent_difference`` to every scored row.

    A row whose key has no average keeps NULL in both. Pass ``averages`` (one row per
    key) as a stored table: Spark then knows its size before it plans the join,
    broadcasts it when that is under the session's threshold, and the scored rows are
    not shuffled. Above the threshold it joins by shuffle, and adaptive execution
    splits a hot key on the scored side. No broadcast is forced.
    """
    return scored.join(averages.select(key, "group_average"), key, "left").withColumn(
        "percent_difference", percent_difference(F.col(prediction), F.col("group_average"))
    )
