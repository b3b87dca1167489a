"""SimHash fingerprints of word shingles, and documents whose fingerprints are close.

Close fingerprints are found by multi-index hashing. A fingerprint of 64 bits has two segments
of 32. If two fingerprints differ by two bits or fewer, they differ by at most one in one of the
segments. So there is a table of fingerprints by the value of each segment; every fingerprint
looks up the small Hamming ball about its own values there, and complete distances are verified
for what it fetches. Values that many fingerprints share are told apart by the other segment.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthwatt.llm.components import components
from hearthwatt.llm.frames import kept_apart, map_rows, stored, text_or_empty

#: Fixed by the definition of the fingerprint.
SEED = 42
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Shingles whose bits are counted at once.
SHINGLES_AT_ONCE = 1 << 15


def words(text: str) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return text.encode().translate(LOWER).split()


def shingles(text: str, size: int) -> list[bytes]:
    """All runs of ``size`` words, repeats included; the whole sequence if it is shorter."""
    found = words(text)
    if len(found) <= size:
        return [b" ".join(found)] if found else []
    joined = b" ".join(found)
    starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in found])])
    begin, end = starts[: len(found) - size + 1].tolist(), (starts[size:] - 1).tolist()
    return [joined[a:b] for a, b in zip(begin, end, strict=True)]


def simhash(text: str, size: int, seed: int = SEED) -> int:
    """A signed 64-bit fingerprint: a bit is 1 if over half the shingles' hashes have it. Zero
    without words."""
    found = shingles(text, size)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(found), SHINGLES_AT_ONCE):
        raw = b"".join([xxhash.xxh64_digest(s, seed) for s in found[start : start + SHINGLES_AT_ONCE]])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(found)).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, size: int, seed: int, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and the ``fingerprint`` of every text."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def compute(rows):
        return {c: rows[c] for c in keep} | {"fingerprint": [simhash(text, size, seed) for text in rows[text_col]]}

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", fingerprint long"
    return map_rows(df.select(*keep, text_or_empty(text_col)), compute, schema)


#: Bits of a segment, and bits that differ at most between close fingerprints.
SEGMENT, DISTANCE = 32, 2
#: A value of a segment is hot if more fingerprints have it; then the other segment joins in.
HOT = 32


def _bit(k: int) -> Column:
    return F.lit(1 << k if k < 63 else -(1 << 63)).cast("long")


def _flips(first: int, last: int) -> Column:
    return F.array(*[_bit(k) for k in range(first, last)])


def segment(fingerprint: Column, part: int) -> Column:
    """The bits of segment 0 (lower) or 1, where they are; the others zero."""
    mask = (1 << SEGMENT) - 1
    return fingerprint.bitwiseAND(F.lit(mask if part == 0 else ~mask).cast("long"))


def segment_table(classes: DataFrame) -> DataFrame:
    """``part``, ``value`` and ``fingerprint``: each fingerprint under both its segments."""
    rows = F.array(*[F.struct(F.lit(p).alias("part"), segment(F.col("fingerprint"), p).alias("value")) for p in (0, 1)])
    return classes.select(F.explode(rows).alias("row"), "fingerprint").select("row.part", "row.value", "fingerprint")


def segment_probes(classes: DataFrame) -> DataFrame:
    """``part``, ``value`` and ``fingerprint`` for all values that a fingerprint looks up: its
    segment and that with one of its ones cleared. Of two segments that differ by a bit one has
    it set, so half of the ball is enough."""
    fingerprint = F.col("fingerprint")

    def values(part: int) -> Column:
        own, flips = segment(fingerprint, part), _flips(SEGMENT * part, SEGMENT * (part + 1))
        cleared = F.transform(F.filter(flips, lambda bit: own.bitwiseAND(bit) != 0), lambda bit: own.bitwiseXOR(bit))
        return F.transform(F.concat(F.array(own), cleared), lambda v: F.struct(F.lit(part).alias("part"), v.alias("value")))

    rows = F.concat(values(0), values(1))
    return classes.select(F.explode(rows).alias("row"), "fingerprint").select("row.part", "row.value", "fingerprint")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def close_fingerprints(classes: DataFrame, hot: int = HOT) -> DataFrame:
    """Pairs that link all fingerprints with at most two different bits, as ``a`` and ``b``.

    A probe fetches at most ``hot`` fingerprints of one value, of which those stay that are
    within two bits in all. Fingerprints and probes of a hotter value take as key that value
    together with the other segment, the fingerprints also with one of its bits flipped. All
    that share such a key are within a bit of it, so within two of each other, and pairs with
    the smallest link them. There are at most 65, whatever the data.
    """
    table, probes = segment_table(classes), segment_probes(classes)
    hot_values = stored(table.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > hot).drop("n"), "hot-values")
    where = ["part", "value"]
    x, y = probes.join(hot_values, where, "left_anti").alias("x"), table.join(hot_values, where, "left_anti").alias("y")
    a, b = F.col("x.fingerprint"), F.col("y.fingerprint")
    same = (F.col("x.part") == F.col("y.part")) & (F.col("x.value") == F.col("y.value"))
    fetched = x.join(y, same & (a != b) & (_distance(a, b) <= DISTANCE)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))

    fingerprint = F.col("fingerprint")
    value = F.col("value")
    part = F.when(F.col("part") == 0, segment(fingerprint, 0)).otherwise(segment(fingerprint, 1))
    other = fingerprint.bitwiseXOR(part)
    flips = F.when(F.col("part") == 0, _flips(SEGMENT, 2 * SEGMENT)).otherwise(_flips(0, SEGMENT))
    whole = value.bitwiseOR(other)
    keys = F.when(value == part, F.concat(F.array(whole), F.transform(flips, lambda bit: whole.bitwiseXOR(bit)))).otherwise(F.array(whole))
    met = probes.join(hot_values, where).select("fingerprint", F.explode(keys).alias("key"))
    met = met.groupBy("key").agg(F.collect_set("fingerprint").alias("near")).where(F.size("near") > 1)
    pairs = met.select(F.array_min("near").alias("a"), F.explode("near").alias("b")).where("a <> b")
    return fetched.union(pairs.where(_distance(F.col("a"), F.col("b")) <= DISTANCE)).distinct()


def simhash_components(
    df: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per document: its id, the ``keep`` columns, its 64-bit ``fingerprint`` in hexadecimal
    and ``component_id``, the smallest id among all documents reachable over links of at most two
    different bits.

    Documents with equal fingerprints are one vertex, so copies are never compared. A null or
    wordless text has fingerprint zero and links like any other; a null id never names a
    component that has another id. Repeated rows stay. Texts are taken whole. Other columns are
    not looked at; a kept one called as a result is left out. An empty table gives no rows.
    """
    names = kept_apart([id_col, *[c for c in keep if c not in (id_col, "fingerprint", "component_id")]])
    picked = df.select(*[F.col(c).alias(r) for c, r in names.items()], F.col(text_col).alias("text"))
    made = stored(fingerprints(picked, size, SEED, list(names.values())), "simhash")
    classes = stored(made.groupBy("fingerprint").agg(F.min("kept_0").alias("first")), "classes")
    labels = components(close_fingerprints(classes)).toDF("fingerprint", "label")
    labelled = classes.join(labels, "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("label", "fingerprint").alias("label")
    )
    named = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    names_of = stored(labelled.join(named, "label").select("fingerprint", "component_id"), "components")
    return made.join(names_of, "fingerprint").select(
        *[F.col(r).alias(c) for c, r in names.items()],
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
