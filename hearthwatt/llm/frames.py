"""What the operators of this package share: stored tables and Arrow passes over rows."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hearthwatt.sources import shared_folder

#: Rows that a Python function sees at once; it bounds a task's memory.
ROWS_AT_ONCE = 256


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from a checkout, as where the driver does so.
    Where it is installed on all machines this changes nothing."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/hearthwatt-llm/{name}-{uuid.uuid4().hex}"


#: Tables stored on the way to a result, for each thread by itself.
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def stored(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back.

    The written table cuts the lineage, survives the loss of executors and tells Spark its
    size before a join. It stays until ``delete``, a ``stored_result`` around it or the owner of
    that folder removes it.
    """
    path = path or new_path(df.sparkSession, name)
    if (scratch := _scratch.get()) is not None:
        scratch.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_result(spark: SparkSession, make: Callable[[], DataFrame], path: str) -> DataFrame:
    """What ``make`` returns, stored at ``path``. All tables that were stored on the way there are
    deleted, also if it fails: the result is written by then and reads none of them."""
    scratch: list[str] = []
    outer = _scratch.set(scratch)
    try:
        return stored(make(), path=path)
    finally:
        _scratch.reset(outer)
        if (held := _scratch.get()) is not None:
            held.append(path)
        for other in scratch:
            if other != path:
                delete(spark, other)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a stored table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where ``df`` has such columns."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in (name + "_" * k for k in range(len(taken) + 1)) if n not in taken) for name in names]


def kept_apart(names: list[str]) -> dict[str, str]:
    """Names under which columns can be carried along whatever they are called."""
    return {name: f"kept_{k}" for k, name in enumerate(names)}


def text_or_empty(name: str):
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def map_rows(df: DataFrame, function: Callable[[dict[str, list]], dict], schema: str) -> DataFrame:
    """Apply ``function`` to columns of a few hundred rows at a time, as Python lists.

    It returns the new columns, of any common length. The frame keeps its partitions.
    """
    find_package(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(start, ROWS_AT_ONCE).to_pydict()
                yield pa.RecordBatch.from_pydict(function(rows), schema=target)

    return df.mapInArrow(run, schema)
