"""Feature vectors, regressors, scoring and model persistence with Spark MLlib.

Everything a score needs (derived columns, category indexes, scaling, regressor)
is fitted on the training rows only and saved as one ``PipelineModel``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import missing, squared
from .comparing import compare_to_average
from .series import FEATURES, LABEL

# Model settings of the hourly forecast.
FORECAST_SETTINGS = {
    "linear": {"maxIter": 50},
    "forest": {"numTrees": 50, "maxDepth": 10, "seed": 42},
    "gbt": {"maxIter": 50, "maxDepth": 6, "seed": 42},
}

# Model settings of the household (appliance) models.
HOUSEHOLD_SETTINGS = {
    "gbt": {"maxIter": 50, "maxDepth": 8, "seed": 42},
    "tree": {"maxDepth": 15, "minInstancesPerNode": 5, "seed": 42},
    "forest": {"numTrees": 50, "maxDepth": 12, "minInstancesPerNode": 5, "seed": 42},
}

# Inputs of the household models, in vector order.
CATEGORIES = {"appliance_type": "appliance_index", "season": "season_index"}
HOUSEHOLD_NUMBERS = ("outdoor_temperature", "household_size", "hour", "month", "day_of_week")
HOUSEHOLD_VECTOR = (
    "appliance_index",
    "outdoor_temperature",
    "season_index",
    "household_size",
    "hour",
    "month",
    "day_of_week",
    "temp_squared",
)

# Labels of a category column at most.
MOST_CATEGORIES = 10_000

# Partitions of the training rows. Trees depend on the partitioning, so it must not
# follow from the machine; a large training set should be given more.
TRAINING_PARTITIONS = 16

# Models fitted at the same time. A fit is hundreds of short passes with as many tasks as there are
# training partitions; another fit's tasks use the cores that those leave idle. No result depends on it.
FITS_AT_ONCE = 3

_REGRESSORS = {
    "linear": LinearRegression,
    "tree": DecisionTreeRegressor,
    "forest": RandomForestRegressor,
    "gbt": GBTRegressor,
}
_RAW, _SCALED = "features_raw", "features"

# Changes the time a fit takes, not its result: deep forests are faster when each
# row's place in the trees is cached between passes.
_SPEED = {"forest": {"cacheNodeIds": True}}


# --- feature steps -----------------------------------------------------------


def interaction_terms(df: DataFrame) -> DataFrame:
    """Adds ``temp_squared``."""
    return df.withColumn("temp_squared", squared(F.col("outdoor_temperature")))


def category_indexer(columns: Mapping[str, str] = CATEGORIES) -> StringIndexer:
    """Category -> index, most frequent first; unseen and NULL get an index of their own."""
    return StringIndexer(
        inputCols=list(columns), outputCols=list(columns.values()), handleInvalid="keep"
    )


def check_categories(df: DataFrame, columns: Mapping[str, str] = CATEGORIES) -> None:
    """Fails if a column has more than ``MOST_CATEGORIES`` labels.

    Indexing brings the labels to the driver, and trees need as many bins.
    """
    counts = df.agg(*(F.count_distinct(name).alias(name) for name in columns)).first()
    for name in columns:
        if counts[name] > MOST_CATEGORIES:
            raise ValueError(f"{name} has {counts[name]} labels; at most {MOST_CATEGORIES} can be indexed")


def index_categories(df: DataFrame, columns: Mapping[str, str] = CATEGORIES) -> DataFrame:
    check_categories(df, columns)
    return category_indexer(columns).fit(df).transform(df)


def assembler(columns: Sequence[str], output: str = _RAW) -> VectorAssembler:
    # "keep" turns a missing number into NaN instead of failing the whole job;
    # fits see complete rows only and scoring returns NULL for such a row.
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="keep")


def scale_columns(
    train: DataFrame, df: DataFrame, columns: Sequence[str], center: bool
) -> DataFrame:
    """Adds ``<column>_scaled``: divided by the deviation in ``train``, optionally centred."""
    steps = Pipeline(
        stages=[
            assembler(columns),
            StandardScaler(inputCol=_RAW, outputCol=_SCALED, withMean=center, withStd=True),
        ]
    )
    scaled = steps.fit(train.dropna(subset=list(columns))).transform(df)
    values = vector_to_array(_SCALED)
    return scaled.withColumns(
        {
            f"{name}_scaled": F.when(F.col(name).isNotNull(), values[index])
            for index, name in enumerate(columns)
        }
    ).drop(_RAW, _SCALED)


def forecast_steps() -> list:
    """Ten series features as a vector, and the same vector standardised."""
    return [
        assembler(FEATURES),
        StandardScaler(inputCol=_RAW, outputCol=_SCALED, withMean=True, withStd=True),
    ]


def household_steps() -> list:
    """Appliance, season, household and weather features as a vector.

    The vector is not scaled: trees do not need it, and scaling would drop the
    metadata that tells them which features are categories.
    """
    return [
        SQLTransformer(
            statement="SELECT *, outdoor_temperature * outdoor_temperature AS temp_squared FROM __THIS__"
        ),
        category_indexer(),
        assembler(HOUSEHOLD_VECTOR),
    ]


# --- fitting -----------------------------------------------------------------


@dataclass(frozen=True)
class FittedModels:
    """Fitted feature steps shared by several fitted regressors."""

    steps: tuple[Transformer, ...]
    regressors: Mapping[str, Model]
    numbers: tuple[str, ...]

    def predictions(self) -> dict[str, str]:
        """Model name -> column that ``score`` puts its predictions in."""
        return {name: f"prediction_{name}" for name in self.regressors}

    def score(self, df: DataFrame) -> DataFrame:
        """Adds one prediction column per model; features are computed once for all.

        Every row is kept. A row with a missing number gets a NULL prediction.
        """
        scored = PipelineModel(list(self.steps)).transform(df)
        for name, model in self.regressors.items():
            column = self.predictions()[name]
            scored = model.copy({model.predictionCol: column}).transform(scored)
        complete = _complete(self.numbers)
        return scored.select(
            *df.columns,
            *(F.when(complete, F.col(c)).alias(c) for c in self.predictions().values()),
        )

    def pipeline(self, name: str) -> PipelineModel:
        """One model with all its feature steps, for saving."""
        return PipelineModel([*self.steps, self.regressors[name]])


def _complete(columns: Sequence[str]):
    result = F.lit(True)
    for name in columns:
        result = result & ~missing(F.col(name))
    return result


def spread(
    df: DataFrame, keys: Sequence[str], partitions: int = TRAINING_PARTITIONS
) -> DataFrame:
    """``partitions`` partitions by hash of ``keys``, whatever the cluster and the files.

    ``keys`` should identify a row, so that no partition grows with a hot value.
    """
    return df.repartition(partitions, *keys)


def _fit(
    train: DataFrame,
    steps: Sequence,
    numbers: Sequence[str],
    label: str,
    settings: Mapping[str, Mapping],
    parallelism: int,
) -> FittedModels:
    train = train.dropna(subset=[label, *numbers])
    fitted = Pipeline(stages=list(steps)).fit(train)
    prepared = fitted.transform(train)
    prepared = prepared.select(
        F.col(label).cast("double").alias("label"),
        *(name for name in (_RAW, _SCALED) if name in prepared.columns),
    )
    bins = max([32] + [len(labels) + 1 for s in fitted.stages for labels in _labels(s)])

    def fit_one(item: tuple[str, Mapping]) -> tuple[str, Model]:
        name, options = item
        extra = {"featuresCol": _SCALED} if name == "linear" else {"featuresCol": _RAW, "maxBins": bins}
        return name, _REGRESSORS[name](labelCol="label", **{**extra, **_SPEED.get(name, {}), **options}).fit(prepared)

    # All fits read these rows, which are shuffled once. Trees keep their own form of them in memory.
    prepared = prepared.persist(StorageLevel.DISK_ONLY)
    try:
        if parallelism == 1:
            models = dict(map(fit_one, settings.items()))
        else:
            with ThreadPoolExecutor(parallelism) as pool:
                task = inheritable_thread_target(train.sparkSession)(fit_one)
                models = dict(pool.map(task, settings.items()))
    finally:
        prepared.unpersist()
    return FittedModels(tuple(fitted.stages), models, tuple(numbers))


def fit_regressor(
    train: DataFrame, steps: Sequence, label: str, name: str, settings: Mapping
) -> tuple[PipelineModel, Model]:
    """Feature steps of the caller's choice and one regressor on their raw vector."""
    fitted = Pipeline(stages=list(steps)).fit(train)
    regressor = _REGRESSORS[name](labelCol=label, featuresCol=_RAW, **settings)
    return fitted, regressor.fit(fitted.transform(train))


def _labels(stage: Transformer) -> list:
    return stage.labelsArray if hasattr(stage, "labelsArray") else []


def fit_forecast(
    train: DataFrame,
    settings: Mapping[str, Mapping] = FORECAST_SETTINGS,
    label: str = LABEL,
    parallelism: int = FITS_AT_ONCE,
) -> FittedModels:
    """Forecast models on a featured hourly series (training rows only)."""
    return _fit(train, forecast_steps(), FEATURES, label, settings, parallelism)


def fit_household(
    train: DataFrame,
    settings: Mapping[str, Mapping] = HOUSEHOLD_SETTINGS,
    label: str = "energy_consumption",
    parallelism: int = FITS_AT_ONCE,
) -> FittedModels:
    """Household models on clean readings (training rows only)."""
    check_categories(train)
    return _fit(train, household_steps(), HOUSEHOLD_NUMBERS, label, settings, parallelism)


# --- persistence and scenarios -----------------------------------------------


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_scenarios(model: PipelineModel, scenarios: DataFrame, averages: DataFrame) -> DataFrame:
    """Scores any number of what-if rows and compares each with its appliance's average."""
    scored = model.transform(scenarios)
    complete = _complete([c for c in HOUSEHOLD_NUMBERS if c in scenarios.columns])
    predicted = scored.select(
        *scenarios.columns, F.when(complete, F.col("prediction")).alias("prediction")
    )
    return compare_to_average(predicted, averages)
