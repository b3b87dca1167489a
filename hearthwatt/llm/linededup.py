"""Removal of repeated passages by windows of three consecutive lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthwatt.llm.frames import fresh

#: Consecutive lines that must repeat together.
WINDOW = 3


def line_windows(
    df: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every window of ``size`` lines: its document, place and 128-bit key. Windows of blank
    lines and documents of fewer lines have none.

    Each line is split off and hashed once; windows hash the hashes. The steps are separate
    columns, as a function inside a lambda would be computed anew for each of its elements.
    """
    lines = F.transform(
        F.split(text_col, "\n", -1),
        lambda x: F.struct(
            F.xxhash64(x).alias("one"), F.xxhash64(F.lit(size), x).alias("two"), (F.trim(x) != "").alias("filled")
        ),
    )
    hashed = df.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("copy"), lines.alias("lines"))

    def window(i: Column) -> Column:
        those = [F.get("lines", i + k) for k in range(size)]
        return F.struct(
            i.alias("place"),
            F.xxhash64(*[line["one"] for line in those]).alias("one"),
            F.xxhash64(*[line["two"] for line in those]).alias("two"),
            F.greatest(*[line["filled"] for line in those]).alias("filled"),
        )

    places = F.sequence(F.lit(0), F.size("lines") - size)
    found = F.when(F.size("lines") >= size, F.transform(places, window))
    # The outer form, as the plain one has Spark compute all windows twice, to see if there are any.
    cut = hashed.select("doc", "copy", F.explode_outer(found).alias("window")).where("window.filled")
    return cut.select("doc", "copy", "window.place", "window.one", "window.two")


def repeated_places(windows: DataFrame) -> DataFrame:
    """The places of each document at which a window begins that occurs before: in a document
    of smaller id, or earlier in the same one."""
    first = F.min(F.struct("doc", "copy", "place")).alias("first")
    known = windows.groupBy("one", "two").agg(first, F.count("*").alias("n")).where("n > 1")
    at = F.struct("doc", "copy", "place")
    later = windows.join(known, ["one", "two"]).where(~at.eqNullSafe(F.col("first")))
    return later.groupBy("doc", "copy").agg(F.collect_set("place").alias("places"))


def dedup_lines(
    df: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows and columns of ``df``, with ``text_col`` rid of repeated passages, and
    ``lines`` and ``lines_removed``.

    A window of lines stays where it first occurs, by id, then text hash, then place; all
    lines that a later occurrence covers go, so overlapping windows remove one longer passage.
    Lines are compared exactly. A null text stays null, with 0 lines; a text without repeats
    is unchanged; one that is only repeats becomes empty. Rows with the same id and text count
    as one document and change alike; a null id comes first. No column is looked at but the
    two named; columns of ``df`` called ``lines`` or ``lines_removed`` are replaced.
    """
    doc, copy, places, split = fresh(df, "its_doc", "its_copy", "its_places", "its_lines")
    found = repeated_places(line_windows(df, size, id_col, text_col)).toDF(doc, copy, places)
    same = F.col(id_col).eqNullSafe(F.col(doc)) & (F.xxhash64(text_col) == F.col(copy))
    lines = F.col(split)
    steps = F.array(*[F.lit(k) for k in range(size)])
    covered = F.array_distinct(F.flatten(F.transform(places, lambda p: F.transform(steps, lambda k: p + k))))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    joined = df.join(found, same, "left").withColumn(split, F.split(F.col(text_col), "\n", -1))
    text = F.when(F.col(places).isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    )
    counted = {
        "lines": F.coalesce(F.when(F.col(text_col).isNotNull(), F.size(lines)), F.lit(0)),
        "lines_removed": F.when(F.col(places).isNull(), 0).otherwise(F.size(covered)),
    }
    return joined.withColumns(counted | {text_col: text}).drop(doc, copy, places, split)
