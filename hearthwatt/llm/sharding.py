"""Shards of nearly equal size by best-fit-decreasing bin packing of groups of equal texts.

A group never leaves its shard. What is packed is the table of distinct group sizes and how many
groups have each: best fit puts equal groups into the same bin until it is full, so one step
places many. That table has fewer rows than the square root of twice all bytes, whatever the
number of documents. Which groups go where then follows from their rank among those of equal
size, and texts themselves are read once and never moved.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hearthwatt.llm.frames import find_package, stored

#: Bytes that a document takes beside its text.
OVERHEAD = 16
#: Rows numbered by one task.
ROWS_AT_ONCE = 50_000
#: A group of more than this share of all rows meets its rows by a broadcast. There are fewer
#: such groups than one over the share.
HOT_SHARE = 0.001

Node = list  # key, priority, left, right


class Tree:
    """Ordered keys in a randomised balanced tree (a treap); priorities are hashes of the keys."""

    def __init__(self):
        self.root: Node | None = None

    def add(self, key: tuple) -> None:
        priority = zlib.crc32(repr(key).encode())
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, [key, priority, None, None]), high)

    def remove(self, key: tuple) -> None:
        parent, side, node = None, 0, self.root
        while node[0] != key:
            parent, side = node, 2 if key < node[0] else 3
            node = node[side]
        rest = self._merge(node[2], node[3])
        if parent is None:
            self.root = rest
        else:
            parent[side] = rest

    def first_from(self, key: tuple) -> tuple | None:
        """The smallest key not below ``key``."""
        found, node = None, self.root
        while node:
            if node[0] >= key:
                found, node = node[0], node[2]
            else:
                node = node[3]
        return found

    def _split(self, node: Node | None, key: tuple) -> tuple[Node | None, Node | None]:
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            node[3] = low
            return node, high
        low, high = self._split(node[2], key)
        node[2] = high
        return low, node

    def _merge(self, low: Node | None, high: Node | None) -> Node | None:
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high


Run = tuple[int, int, int, int]  # size, first rank, number of groups, bin


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int, most: int) -> list[Run] | None:
    """Bins of ``capacity`` for groups given as (size, how many), largest first: each group goes to
    the bin with the least room that it fits, or a new one. None if that takes over ``most`` bins
    or a group fits none."""
    room, used, runs = Tree(), 0, []
    for size, count in sizes:
        rank = 0
        while rank < count:
            best = room.first_from((size,))
            if best is None:
                if used == most or size > capacity:
                    return None
                best = (capacity, used)
                used += 1
            else:
                room.remove(best)
            # A bin that took a group is the tightest for the next one too, as long as it fits.
            here = min(count - rank, best[0] // size)
            runs.append((size, rank, here, best[1]))
            room.add((best[0] - here * size, best[1]))
            rank += here
    return runs


def level_bins(sizes: list[tuple[int, int]], bins: int) -> list[Run]:
    """Best-fit-decreasing into ``bins`` bins of the smallest capacity found that suffices.

    A group larger than an even share of what is left has a bin for itself. Capacities are then
    halved in between an even share and that share plus the largest group, which always suffices:
    a bin without room for a group is over its share.
    """
    left, alone = sorted(([s, n] for s, n in sizes), reverse=True), []
    total = sum(s * n for s, n in left)
    while left and bins > 1 and left[0][0] * bins > total:
        size = left[0][0]
        taken = sum(1 for a in alone if a[0] == size)
        alone.append((size, taken, 1, len(alone)))
        left[0][1] -= 1
        total, bins = total - size, bins - 1
        if not left[0][1]:
            left.pop(0)
    if not left:
        return alone
    ranks = {}
    for size, *_ in alone:
        ranks[size] = ranks.get(size, 0) + 1
    rest = [(s, n) for s, n in left]
    low = max(-(-total // bins), rest[0][0]) - 1
    high = -(-total // bins) + rest[0][0]
    best = best_fit_decreasing(rest, high, bins)
    while high - low > 1:
        middle = (low + high) // 2
        found = best_fit_decreasing(rest, middle, bins)
        low, high, best = (low, middle, found) if found else (middle, high, best)
    return alone + [(s, first + ranks.get(s, 0), n, b + len(alone)) for s, first, n, b in best]


def _runs(histogram: DataFrame, shards: int) -> DataFrame:
    """``weight``, the ranks ``first`` to ``last`` of groups of that weight, and their ``shard``."""
    schema = "weight long, first long, last long, shard int"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def pack(table: pa.Table) -> pa.Table:
        sizes = zip(table["weight"].to_pylist(), table["n"].to_pylist(), strict=True)
        found = [(s, first, first + n - 1, b) for s, first, n, b in level_bins(list(sizes), shards)]
        columns = list(zip(*found, strict=True)) or [[]] * 4
        return pa.Table.from_pydict(dict(zip(target.names, columns, strict=True)), schema=target)

    return histogram.groupBy().applyInArrow(pack, schema)


def _numbered(df: DataFrame, key: str, spread: str, rows: int, name: str, order: list[str]) -> DataFrame:
    """``df`` with ``number``, from 0 without gaps within ``key``. A key of any number of rows is
    dealt over parts by a hash of ``spread``; the parts' counts are added up, and rows are numbered
    within a part."""
    parts = max(1, -(-rows // ROWS_AT_ONCE))
    dealt = df.withColumn("part", F.pmod(F.xxhash64(spread), F.lit(parts)))
    counts = dealt.groupBy(key, "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(key).alias("its_key"), F.col("part").alias("its_part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    starts = stored(starts, name)
    within = Window.partitionBy(key, "part").orderBy(*order)
    ranked = dealt.withColumn("within", F.row_number().over(within) - 1)
    same = (F.col(key) == F.col("its_key")) & (F.col("part") == F.col("its_part"))
    return ranked.join(starts, same).withColumn("number", F.col("start") + F.col("within")).drop("its_key", "its_part", "part", "within", "start")


def _with_shards(slim: DataFrame, placed: DataFrame, rows: int) -> DataFrame:
    """``slim`` with the shard of each row's group. Rows of hot groups stay where they lie; only
    the others are shuffled by group, so no task gets more than a small share of the table."""
    hot = placed.where(F.col("n") > rows * HOT_SHARE).drop("n")
    usual = placed.where(F.col("n") <= rows * HOT_SHARE).drop("n")
    same = F.col("copy") == F.col("its_copy")
    heavy = slim.join(F.broadcast(hot), same)
    others = slim.join(F.broadcast(hot), same, "left_anti").join(usual, same)
    return heavy.unionByName(others).drop("copy", "its_copy")


def shard_documents(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its ``size`` in bytes, the CRC-32 of its text, its ``shard`` and its
    ``slot`` there, from 0 without gaps. The law is ``bytes``: sizes of shards are as near to each
    other as best-fit-decreasing gets them, so ``grown_shard`` is null.

    Documents of equal text are one group and share a shard, also one of a third of all rows,
    which then has a shard of its own, the others being equal among themselves. A null text
    counts as empty. Rows of equal or no id are documents of their own; texts of any length are
    read where they lie. Fewer groups than shards leave shards empty. Other columns are not looked
    at. An empty table gives no rows.
    """
    find_package(df.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("copy"),
    )
    slim = stored(slim.withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    rows = slim.count()
    groups = stored(slim.groupBy("copy").agg(F.sum("size").alias("weight"), F.count("*").alias("n")), "shard-groups")
    histogram = stored(groups.groupBy("weight").agg(F.count("*").alias("n")), "shard-sizes")
    runs = stored(_runs(histogram, shards), "shard-runs")

    ranked = _numbered(groups, "weight", "copy", rows, "shard-ranks", ["copy"])
    known = runs.withColumnRenamed("weight", "run_weight")
    here = (F.col("weight") == F.col("run_weight")) & F.col("number").between(F.col("first"), F.col("last"))
    placed = stored(ranked.join(known, here).select(F.col("copy").alias("its_copy"), "n", "shard"), "shard-places")
    sharded = stored(_with_shards(slim, placed, rows), "shard-documents")
    slots = _numbered(sharded, "shard", "row", rows, "shard-slots", ["doc_id", "row"])
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("number").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
