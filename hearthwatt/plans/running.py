"""What both jobs need to start: arguments, a session, and a place for checkpoints."""

from __future__ import annotations

from argparse import ArgumentParser
from collections.abc import Iterable

from pyspark.sql import SparkSession

from ..operators.modelling import TRAINING_PARTITIONS


def add_job_arguments(parser: ArgumentParser) -> None:
    parser.add_argument("--parallelism", type=int, default=1, help="models fitted at the same time")
    parser.add_argument("--checkpoint-dir", help="folder all executors share; boosted trees need one")
    parser.add_argument("--training-partitions", type=int, default=TRAINING_PARTITIONS)


def job_session(name: str, checkpoint_dir: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    if checkpoint_dir and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def needs_checkpoints(spark: SparkSession, models: Iterable[str]) -> None:
    """Boosting adds to its lineage in every round and cuts it at checkpoints. Without a folder
    for them a cluster would recompute from the start after a lost executor."""
    context = spark.sparkContext
    if "gbt" in models and not context.getCheckpointDir() and not context.master.startswith("local"):
        raise RuntimeError("boosted trees need --checkpoint-dir, a folder all executors share")
