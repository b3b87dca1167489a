"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest hash among its inner s-mers is its
first or its last one's. That depends on the k-mer alone, so an edit changes only the anchors
that overlap it, and any ``K - S`` consecutive k-mers have one. A fingerprint lists all anchors of
a text in order, each as the gap to the one before and 16 bits of its hash. Two fingerprints are
compared by position: anchors of equal hash are paired, and the longest run of pairs that come
in the same order in both counts.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hearthwatt.llm.frames import ROWS_AT_ONCE, find_package, map_rows, text_or_empty
from hearthwatt.llm.ordering import numbered

#: Code points of an anchor and of its inner substrings, for texts of any length; the steps of
#: anchors() fix both.
K, S = 32, 8
#: Documents of one range of ids at most. One key a range is known to all tasks.
DOCUMENTS_AT_ONCE = 50_000

#: Powers of the base of the k-mer hash, which is taken modulo 2^64.
BASE, BASE_2, BASE_4, BASE_8, BASE_16 = (np.uint64(pow(0x9E3779B97F4A7C15, n, 1 << 64)) for n in (1, 2, 4, 8, 16))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits of 64 over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions (code points) and 64-bit hashes of a text's anchors, in order.

    ``K`` - 1 characters that no text has stand before the text, so that a text of any length
    has k-mers; an anchor that begins among them has a negative position. The last k-mer is an
    anchor too, so that only the empty text has none.
    """
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    points = np.concatenate([np.arange(0x110000, 0x110000 + K - 1), points]).astype(np.uint64)
    two = points[:-1] * BASE + points[1:]
    four = two[:-2] * BASE_2 + two[2:]
    eight = four[:-4] * BASE_4 + four[4:]
    sixteen = eight[:-8] * BASE_8 + eight[8:]
    whole = sixteen[:-16] * BASE_16 + sixteen[16:]
    inner = _mixed(eight)
    low = np.minimum(inner[:-1], inner[1:])
    for step in (2, 4, 8):
        low = np.minimum(low[:-step], low[step:])
    low = np.minimum(low[: len(whole)], low[K - S - 15 :])
    chosen = (low == inner[: len(whole)]) | (low == inner[K - S :])
    chosen[-1] = True
    at = np.flatnonzero(chosen)
    return at - (K - 1), _mixed(whole[at])


def sketch(text: str) -> np.ndarray:
    """All anchors in order, as rows of the gap to the one before and 16 bits of the hash. The
    first gap counts from the first possible position."""
    at, hashes = anchors(text)
    out = np.empty(len(at), [("gap", "u1"), ("hash", ">u2")])
    out["gap"] = np.diff(at, prepend=-(K - 1))
    out["hash"] = hashes >> np.uint64(48)
    return out


def as_text(found: np.ndarray) -> str:
    return found.tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), [("gap", "u1"), ("hash", ">u2")])


def positions(found: np.ndarray) -> np.ndarray:
    """Where the anchors of a fingerprint begin."""
    return np.cumsum(found["gap"], dtype=np.int64) - (K - 1)


def _occurrences(found: np.ndarray) -> np.ndarray:
    """A number for each anchor that tells its hash and how often that came before."""
    hashes = found["hash"].astype(np.int64)
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, int)
    rank = np.empty(len(ranked), np.int64)
    rank[order] = np.arange(len(ranked)) - np.repeat(starts, np.diff(np.append(starts, len(ranked))))
    return hashes << 32 | rank


def matched(one: np.ndarray, other: np.ndarray) -> int:
    """Anchors matched by position: the n-th of a hash is paired with the n-th of it in the other,
    and the longest run of pairs in the same order in both is taken."""
    _, i, j = np.intersect1d(_occurrences(one), _occurrences(other), assume_unique=True, return_indices=True)
    places = j[np.argsort(i)]
    if len(places) < 2 or (places[1:] > places[:-1]).all():
        return len(places)
    ends: list[int] = []
    for place in places.tolist():
        if not ends or place > ends[-1]:
            ends.append(place)
        else:
            ends[bisect_left(ends, place)] = place
    return len(ends)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """The matched anchors' share of all anchors of both; 1 for two empty texts."""
    if not len(one) and not len(other):
        return 1.0
    both = matched(one, other)
    return both / (len(one) + len(other) - both)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint``, and the anchors with their positions and whole hashes. A null
    text is an empty one, without anchors; a text of any length has all of its anchors."""
    kind = df.schema[id_col].dataType.simpleString()

    def compute(rows):
        found = [anchors(t) for t in rows["text"]]
        return {
            "id": rows["id"],
            "fingerprint": [as_text(sketch(t)) for t in rows["text"]],
            "positions": [at for at, _ in found],
            "hashes": [h.view(np.int64) for _, h in found],
        }

    schema = f"id {kind}, fingerprint string, positions array<long>, hashes array<long>"
    picked = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return map_rows(picked, compute, schema).withColumnRenamed("id", id_col)


def edited_by_next(text: str, following: str) -> str:
    """The last third, rounded down, replaced by as much of the beginning of another text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def fingerprints_with_edits(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents_at_once: int = DOCUMENTS_AT_ONCE
) -> DataFrame:
    """Fingerprints of all texts and of edited ones, made with the next text by falling id, and
    their likenesses, which follow from the fingerprints alone.

    Texts are dealt by ranges of the order once; each range also gets the first text of the range
    that follows it, and the last range that of the first. The ranges are cut by the rows' places
    in the order, which are found without the texts; what all tasks know of them is one key for
    each range, of three numbers for ``documents_at_once`` rows. A null text is an empty one, a
    text of any length is taken whole. Null ids come last; rows of one id or none follow each
    other by a hash of their texts and are cut into ranges like others; only rows that agree in
    both stay together. The only row of a table is its own next. Other columns are not looked at.
    An empty table gives no rows.
    """
    spark = df.sparkSession
    find_package(spark)
    texts = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    # Falling ids are rising complements, which exist for every id.
    keys = {"none": F.col("id").isNull(), "falling": F.coalesce(F.bitwise_not("id"), F.lit(0)), "copy": F.xxhash64("text")}
    keyed, names = texts.withColumns(keys), list(keys)
    rows = df.count()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // documents_at_once))
    width = max(1, -(-rows // (4 * tasks)))
    placed = numbered(keyed.select(names).withColumn("tree", F.lit(0)), "tree", names, rows, "order")
    cuts = sorted({tuple(r) for r in placed.where(F.col("place") % width == 0).select(names).collect()})
    shipped = spark.sparkContext.broadcast(cuts)
    dealt_schema = "place int, guest boolean, none boolean, falling long, copy long, id long, text string"
    out_schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    dealt_target = to_arrow_schema(StructType.fromDDL(dealt_schema))
    out_target = to_arrow_schema(StructType.fromDDL(out_schema))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(start, ROWS_AT_ONCE)
                order = list(zip(*(some.column(c).to_pylist() for c in names), strict=True))
                places = [bisect_right(known, key) - 1 for key in order]
                # The first rows of a range are also the guests of the one before it.
                guests = [i for i, key in enumerate(order) if key == known[places[i]]]
                each = pa.array([*range(some.num_rows), *guests])
                columns = [
                    pa.array(places + [(places[i] - 1) % len(known) for i in guests], pa.int32()),
                    pa.array([False] * some.num_rows + [True] * len(guests)),
                    *(some.column(c).take(each) for c in dealt_target.names[2:]),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=dealt_target)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                some, out = batch.slice(start, ROWS_AT_ONCE), []
                for guest, doc, text in zip(*(some.column(c).to_pylist() for c in ("guest", "id", "text")), strict=True):
                    if guest and held is None:
                        continue
                    row = (doc, text, sketch(text))
                    if held is not None:
                        out.append(_compared(held, row))
                    held = None if guest else row
                columns = zip(*out, strict=True) if out else [[]] * len(out_target.names)
                yield pa.RecordBatch.from_pydict(
                    dict(zip(out_target.names, map(list, columns), strict=True)), schema=out_target
                )

    dealt = keyed.mapInArrow(deal, dealt_schema).repartition(tasks, "place")
    ordered = dealt.sortWithinPartitions("place", "guest", *names)
    found = ordered.select("guest", "id", "text").mapInArrow(edit, out_schema)
    return found if id_col == "doc_id" else found.withColumnRenamed("doc_id", id_col)


def _compared(row: tuple, following: tuple) -> tuple:
    doc, text, own = row
    edited = edited_by_next(text, following[1])
    changed = sketch(edited)
    return (
        doc,
        len(text),
        hashlib.sha256(edited.encode()).hexdigest(),
        as_text(own),
        as_text(changed),
        likeness(own, changed),
        likeness(own, following[2]),
    )
