"""Regression metrics as plain aggregates, for any number of models at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import missing

# Fixed value: stands in for a label of zero when a percentage error is taken.
ZERO_LABEL = 1e-9


def metric_columns(label: Column, prediction: Column, skip_zero: bool = False) -> list[Column]:
    """Aggregates over the rows where label and prediction are both present.

    ``mape`` replaces a zero label by a tiny number, which makes it huge;
    ``skip_zero`` leaves such rows out of it instead. ``zero_labels`` says how many
    there are. ``r2`` is NULL when the label does not vary.
    """
    both = ~missing(label) & ~missing(prediction)
    actual = F.when(both, label)
    error = F.when(both, label - prediction)
    base = F.when(actual != 0, actual) if skip_zero else F.when(actual == 0, ZERO_LABEL).otherwise(actual)
    total = F.var_pop(actual) * F.count(actual)
    r2 = 1 - F.try_divide(F.sum(error * error), total)
    return [
        F.count(actual).alias("rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        r2.alias("r2"),
        (r2 * 100).alias("r2_pct"),
        (F.avg(F.abs(error / base)) * 100).alias("mape"),
        F.count_if(actual == 0).alias("zero_labels"),
    ]


def metric_suite(
    df: DataFrame, label: str = "label", prediction: str = "prediction", skip_zero: bool = False
) -> DataFrame:
    """All metrics of one prediction column in one row."""
    return df.agg(*metric_columns(F.col(label), F.col(prediction), skip_zero))


def metric_table(
    df: DataFrame,
    predictions: Mapping[str, str],
    label: str = "label",
    by: Sequence[str] = (),
    skip_zero: bool = False,
) -> DataFrame:
    """All metrics of all models from one pass: a row per model (and per ``by``).

    ``predictions`` maps a model name to its prediction column. Rows are unfolded
    inside each task and aggregated there; only the partial sums are shuffled.
    """
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias("model"), F.col(column).cast("double").alias("prediction"))
            for name, column in predictions.items()
        )
    )
    return (
        df.select(*by, F.col(label).alias("label"), F.inline(pairs))
        .groupBy("model", *by)
        .agg(*metric_columns(F.col("label"), F.col("prediction"), skip_zero))
    )


def best_model(table: DataFrame, metric: str = "rmse", largest: bool = False) -> DataFrame:
    """The row with the best metric; names decide between equals."""
    order = F.desc_nulls_last(metric) if largest else F.asc_nulls_last(metric)
    return table.orderBy(order, "model").limit(1)


def best_model_name(table: DataFrame, metric: str = "rmse", largest: bool = False) -> str:
    """Name of the best model; one row comes to the driver."""
    row = best_model(table, metric, largest).first()
    if row is None:
        raise ValueError("no rows to choose a model by: the series is too short or has too many gaps")
    return row["model"]
