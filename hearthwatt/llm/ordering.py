"""Places of rows in an order, without bringing the rows together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthwatt.llm.frames import stored

#: Rows that a task orders and numbers: fewer tasks for a small table, more for a large one.
LEAST_ROWS, MOST_ROWS = 1_000, 200_000


def numbered(df: DataFrame, tree: str, order: list[str], rows: int, name: str) -> DataFrame:
    """``df`` with ``place``, from 0 by ``order`` within each value of ``tree`` (nulls first), and
    ``leaves``, the tree's number of rows.

    Rows are dealt by ranges, so that a tree that holds most of them spreads over many tasks.
    What is added up over the ranges is one small row for each tree in a range.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, -(-rows // MOST_ROWS), min(usual, -(-rows // LEAST_ROWS)))
    dealt = df.repartitionByRange(ranges, tree, *order).sortWithinPartitions(tree, *order)
    dealt = stored(dealt.withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), name)
    parts = stored(dealt.groupBy(tree, "part").agg(F.min("row").alias("first"), F.count("*").alias("n")), f"{name}-parts")
    earlier = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = parts.select(
        F.col(tree).alias("its_tree"),
        F.col("part").alias("its_part"),
        "first",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy(tree)).alias("leaves"),
    )
    same = (F.col("part") == F.col("its_part")) & F.col(tree).eqNullSafe(F.col("its_tree"))
    placed = dealt.join(counted, same).withColumn("place", F.col("before") + F.col("row") - F.col("first"))
    return placed.drop("its_tree", "its_part", "first", "before", "part", "row")
