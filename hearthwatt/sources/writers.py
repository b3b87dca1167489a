"""Writers for results and for tables that several later jobs read."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), rebalance: bool = False
) -> None:
    """Write Parquet, replacing what is there, optionally as partition folders.

    Without ``rebalance`` each task writes its own file per folder, which suits a
    handful of folders. For many folders ``rebalance=True`` first brings the rows of
    a folder together; adaptive execution splits a folder that holds far more rows
    than the others over several tasks.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_single_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header. Only for tables of a few rows, such as metrics."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


_written: list[str] = []


def written_once(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Compute ``df`` once into a shared Parquet table and read it back.

    Iterative fits read their input many times. A written table survives the loss
    of executors, cuts the lineage, and still prunes columns. It is written when this
    is called, under ``path`` or a new name in the shared folder; ``delete_written``
    removes the tables without a ``path`` when their results are no longer needed.
    """
    spark = df.sparkSession
    if path is None:
        path = f"{shared_folder(spark)}/hearthwatt-{name}-{uuid.uuid4().hex}"
        _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_written(spark: SparkSession) -> None:
    """Delete all tables that ``written_once`` named itself."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


def shared_folder(spark: SparkSession) -> str:
    """What the session names: ``spark.checkpoint.dir``, or where that is unset, in a session of
    one process, its warehouse folder. On a cluster that may be a folder of one machine, so there
    the setting must be given."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
