"""Repeatable pseudo-random choice of rows.

``randomSplit`` and ``sample`` depend on how rows are spread over partitions, so a
retry or another cluster size changes the result. A choice hashed from the row key
depends on the key and the seed only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGE = 2**32


def in_first_share(share: float, *keys: str, seed: int = 42, portable: bool = True) -> Column:
    """True for a fixed ``share`` of the key space; a larger share contains a smaller one.

    ``portable`` compares md5 hex text, which any SQL engine can repeat. Otherwise
    Spark's xxhash64 is used: it needs no text form of the keys and is several times
    faster on wide keys.
    """
    if not 0 <= share <= 1:
        raise ValueError(f"share must lie between 0 and 1, not {share}")
    cut = round(share * _RANGE)
    if cut == _RANGE:
        return F.lit(True)
    if portable:
        text = F.concat_ws(":", F.lit(str(seed)), *(_key_text(key) for key in keys))
        return F.md5(text) < F.lit(f"{cut:08x}")
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 32) < F.lit(cut)


def _key_text(key: str) -> Column:
    # concat_ws skips NULL; the marker keeps (NULL, 'a') and ('a', NULL) apart.
    return F.coalesce(F.col(key).cast("string"), F.lit("\\N"))
