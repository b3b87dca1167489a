"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthwatt.llm.frames import delete, new_path, stored


def components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``label``, the smallest vertex it can reach, for bigint pairs ``a``, ``b``.

    In each round a vertex takes the smallest label among its neighbours, then the label of
    that label. Labels only fall, so an unchanged sum ends the loop. Every round is one
    written table, and the one before it is deleted; a vertex with very many edges is spread by partial minima and by adaptive
    splitting of the joins. Without edges there are no rows.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = stored(both.toDF("vertex", "other"), "edges")
    path = new_path(spark, "labels")
    labels = stored(
        both.groupBy("vertex").agg(F.min("other").alias("near")).select("vertex", F.least("vertex", "near").alias("label")), path=path
    )
    total = _sum(labels)
    while True:
        near = (
            both.join(labels.toDF("other", "theirs"), "other")
            .groupBy("vertex")
            .agg(F.min("theirs").alias("near"))
        )
        nearer = labels.join(near, "vertex").select("vertex", F.least("label", "near").alias("label"))
        known = labels.toDF("label", "further")
        following = nearer.join(known, "label").select("vertex", F.least("label", "further").alias("label"))
        last, path = path, new_path(spark, "labels")
        labels = stored(following, path=path)
        delete(spark, last)
        before, total = total, _sum(labels)
        if before == total:
            return labels


def _sum(labels: DataFrame):
    return labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
