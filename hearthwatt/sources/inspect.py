"""Looking at a table: its columns and its first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_REPORT = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("column", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("nullable", T.BooleanType()),
    ]
)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column, from the schema alone; no data is read."""
    rows = [
        (position, field.name, field.dataType.simpleString(), field.nullable)
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(rows, _REPORT)


def preview_rows(df: DataFrame, order_by: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows in the given order (a top-n, not a sort of the table)."""
    return df.orderBy(*order_by).limit(n)
