"""Which labelled documents a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One document in FOLDS is held out, by the CRC-32 of its id as text.
FOLDS = 5


def held_out(id_col: str = "doc_id") -> Column:
    """A null id is not held out."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % FOLDS == 0, F.lit(False))


def training_labels(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ``label`` of the rows that are not held out. Rows without id or label
    are left out; of several labels of one id the mean is taken."""
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col))
    return usable.groupBy(id_col).agg(F.avg(label).alias("label"))


def bounded_sample(labels: DataFrame, bound: int, id_col: str = "doc_id") -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of the id: all of them if there are no
    more. Only for fitting a classifier, of whose sample this is the documented bound."""
    share = min(1.0, bound / max(1, labels.count()))
    spread = 1 << 30
    return labels.where(F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(spread)) < int(spread * share))
