"""Readers. Schemas are declared, never inferred: inference costs a full scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import RAW_READING


def read_csv_readings(
    spark: SparkSession, path: str, schema: T.StructType = RAW_READING
) -> DataFrame:
    """Meter export in CSV with a header line.

    A value that does not fit its declared type becomes NULL, the row is kept;
    ``quality_report`` counts such rows.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
        .csv(path)
    )


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet directory; pass ``schema`` to skip reading file footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def literal_rows(
    spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str
) -> DataFrame:
    """A few hand-given rows (scenarios, metrics) with explicit types."""
    return spark.createDataFrame(list(rows), schema)
