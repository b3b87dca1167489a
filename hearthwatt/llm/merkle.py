"""A Merkle manifest of a table: one tree per source, one tree over the sources, and proofs.

Trees are cut into aligned blocks of a fixed height. A block is one row whose nodes are stored
in van Emde Boas order: the levels are split at half height, the upper part comes first, the
lower subtrees follow one after the other, and each part is laid out the same way. The address
of a node follows from its depth and index alone, so building a block and fetching siblings
need no pointers and touch few cache lines at any cache size. The roots of the blocks are the
leaves of the next tier of blocks, and so on up to the root.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hearthwatt.llm.frames import find_package, stored
from hearthwatt.llm.ordering import numbered

#: Consecutive nodes that become one.
RUN = 3
#: Levels between the leaves and the root of a block, which so has up to 729 leaves.
BLOCK_HEIGHT = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


@cache
def address(levels: int, depth: int, index: int) -> int:
    """The place of a node in a tree of so many levels, the root being of depth 0."""
    if levels == 1:
        return 0
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below, span = levels - top, RUN ** (depth - top)
    return _nodes(top) + index // span * _nodes(below) + address(below, depth - top, index % span)


def _nodes(levels: int) -> int:
    return (RUN**levels - 1) // (RUN - 1)


def build(leaves: list[str], height: int) -> list[str | None]:
    """The nodes of a block over up to ``RUN ** height`` leaves, in van Emde Boas order. A run
    of one node is hashed too. Places without a node are null."""
    nodes: list[str | None] = [None] * _nodes(height + 1)
    for level in range(height + 1):
        if level:
            leaves = [digest(*leaves[i : i + RUN]) for i in range(0, len(leaves), RUN)]
        for index, node in enumerate(leaves):
            nodes[address(height + 1, height - level, index)] = node
    return nodes


def siblings(nodes: list[str | None], height: int, index: int) -> tuple[list[str], list[str]]:
    """For each level from the leaf ``index`` up: the run's nodes to its left, those to its
    right, each as one text."""
    lefts, rights = [], []
    for depth in range(height, 0, -1):
        first = index - index % RUN
        run = [nodes[address(height + 1, depth, k)] or "" for k in range(first, first + RUN)]
        lefts.append("".join(run[: index - first]))
        rights.append("".join(run[index - first + 1 :]))
        index //= RUN
    return lefts, rights


def fold(node: str, lefts: list[str], rights: list[str]) -> str:
    for left, right in zip(lefts, rights, strict=True):
        node = digest(left, node, right)
    return node


def height_of(leaves: int) -> int:
    """Levels that so many leaves need until one node remains."""
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // RUN), height + 1
    return height


def leaf(text: Column, fields: tuple[str, ...] = FIELDS) -> Column:
    """The digest of a row's fields, each preceded by its length in bytes, or ``-`` for null."""

    def coded(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[coded(text if f == "text" else F.col(f)) for f in fields]).cast("binary"), 256)


def blocks(nodes: DataFrame, tree: str, members: dict[str, str], height: int, name: str) -> DataFrame:
    """One row per block of ``nodes`` (``tree``, ``place``, ``leaves``, ``digest`` and the columns
    of ``members``): its place ``block`` among the tree's ``blocks``, the tree's ``leaves``, its
    ``height``, its ``nodes`` in van Emde Boas order, its ``root``, and the members as arrays.

    A block of a tree with several is folded to its full height, however few leaves it has, so
    that all their roots are nodes of one level of the tree.
    """
    find_package(nodes.sparkSession)
    kind = nodes.schema[tree].dataType.simpleString()
    lists = ", ".join(f"{c} array<{t}>" for c, t in members.items())
    schema = f"`{tree}` {kind}, block long, blocks long, leaves long, height int, nodes array<string>, root string"
    schema += f", {lists}" if lists else ""
    target, width = to_arrow_schema(StructType.fromDDL(schema)), RUN**height

    def make(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        leaves, whole = rows["digest"].to_pylist(), rows["leaves"][0].as_py()
        own = height if whole > width else height_of(whole)
        found = build(leaves, own)
        fixed = [key[0].as_py(), key[1].as_py(), -(-whole // width), whole, own, found, found[0]]
        held = [rows[c].to_pylist() for c in members]
        return pa.Table.from_pydict(dict(zip(target.names, [[v] for v in fixed + held], strict=True)), schema=target)

    keyed = nodes.withColumn("block", F.floor(F.col("place") / width))
    return stored(keyed.groupBy(tree, "block").applyInArrow(make, schema), name)


def tiers(nodes: DataFrame, tree: str, members: dict[str, str], height: int, largest: int, name: str) -> list[DataFrame]:
    """The blocks over the leaves, those over the roots of trees of several blocks, and so on."""
    out = [blocks(nodes, tree, members, height, f"{name}-0")]
    while (largest := -(-largest // RUN**height)) > 1:
        several = out[-1].where("blocks > 1")
        roots = several.selectExpr(tree, "block AS place", "blocks AS leaves", "root AS digest")
        out.append(blocks(roots, tree, {}, height, f"{name}-{len(out)}"))
    return out


NO_NODES = "CAST(array() AS array<string>)"
PATH = "lefts array<string>, rights array<string>, subroot string, root string"


def paths_below(upper: DataFrame, tree: str, height: int, name: str) -> DataFrame:
    """For each leaf of the blocks of ``upper``, which carry the way from their root to the whole
    root in ``lefts`` and ``rights``: its place as ``block`` and its own way."""
    kind = upper.schema[tree].dataType.simpleString()
    schema = f"`{tree}` {kind}, block long, {PATH}"
    target, width = to_arrow_schema(StructType.fromDDL(schema)), RUN**height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
                out: dict[str, list] = {c: [] for c in target.names}
                first = row["block"] * width
                count = min(row["leaves"] - first, width)
                for index in range(count):
                    lefts, rights = siblings(row["nodes"], row["height"], index)
                    values = (row[tree], first + index, lefts + row["lefts"], rights + row["rights"], row["subroot"], row["whole"])
                    for held, value in zip(out.values(), values, strict=True):
                        held.append(value)
                yield pa.RecordBatch.from_pydict(out, schema=target)

    return stored(upper.mapInArrow(run, schema), name)


def with_paths(held: DataFrame, paths: DataFrame, tree: str) -> DataFrame:
    """Blocks joined to the way of their root, by tree and place."""
    known = paths.select(
        F.col(tree).alias("path_tree"), F.col("block").alias("path_block"), "lefts", "rights", "subroot", F.col("root").alias("whole")
    )
    same = (F.col("block") == F.col("path_block")) & F.col(tree).eqNullSafe(F.col("path_tree"))
    return held.join(known, same).drop("path_tree", "path_block")


def merkle_manifest(
    df: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", tree_col: str = "source", height: int = BLOCK_HEIGHT
) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, its ``leaf``, its source's ``subroot``, the ``root``,
    the ``proof_sha256`` of all siblings on its way, the ``folded_root`` from a tampered or else
    the original leaf and those siblings, and whether that is the root (``verified``).

    Tampering removes line ends from the texts of rows whose id has an even CRC-32. A null field
    is coded apart from an empty one; a row without id is not tampered with and comes first in
    its source; rows without source are a tree of their own, the first. Rows of equal id are
    ordered by digest, so repeated rows give the same tree in any order. A lone leaf is its
    subroot, a lone subroot the root, both with the proof of no siblings. Texts of any length are
    hashed where they lie and never moved. Other columns are not looked at. An empty table gives
    no rows.
    """
    find_package(df.sparkSession)
    picked = df.select(*fields)
    even = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0
    changed = F.translate("text", "\n", "")
    tampered = F.when(even & (F.col("text") != changed), leaf(changed, fields))
    leaves = picked.select(
        F.col(id_col).alias("id"), F.col(tree_col).alias("tree"), leaf(F.col("text"), fields).alias("digest"), tampered.alias("tampered")
    )
    leaves = stored(leaves.withColumn("salt", F.monotonically_increasing_id()), "merkle-leaves")
    rows = leaves.count()
    placed = numbered(leaves, "tree", ["id", "digest", "salt"], rows, "merkle-placed")
    largest = placed.agg(F.max("leaves")).first()[0] or 0
    kind = df.schema[id_col].dataType.simpleString()
    low = tiers(placed, "tree", {"id": kind, "tampered": "string"}, height, largest, "merkle-blocks")

    tops = [t.where("blocks = 1").select("tree", F.col("root").alias("digest"), F.lit(k).alias("tier")) for k, t in enumerate(low)]
    subroots = reduce(DataFrame.union, tops).withColumn("forest", F.lit(0))
    subroots = stored(subroots, "merkle-subroots")
    sources = subroots.count()
    ordered = numbered(subroots, "forest", ["tree"], sources, "merkle-sources")
    high = tiers(ordered, "forest", {}, height, sources, "merkle-upper")

    # Down again: from the whole root to the sources, then from each subroot to its leaves.
    start = {"lefts": F.expr(NO_NODES), "rights": F.expr(NO_NODES), "subroot": F.lit("")}
    paths = high[-1].select("forest", "block", "root").withColumns(start)
    for k in range(len(high) - 1, -1, -1):
        paths = paths_below(with_paths(high[k], paths, "forest"), "forest", height, f"merkle-ways-{k}")
    ways = paths.select(F.col("block").alias("place"), "lefts", "rights", "root").join(ordered.select("place", "tree", "tier", "digest"), "place")
    ways = ways.select("tree", "tier", F.lit(0).cast("long").alias("block"), "lefts", "rights", F.col("digest").alias("subroot"), "root")
    ways = stored(ways, "merkle-source-ways")
    for k in range(len(low) - 1, -1, -1):
        tops = ways.where(F.col("tier") == k).drop("tier")
        paths = tops if k == len(low) - 1 else paths.unionByName(tops)
        if k:
            paths = paths_below(with_paths(low[k], paths, "tree"), "tree", height, f"merkle-paths-{k}")
    return _proofs(with_paths(low[0], paths, "tree"), kind)


def _proofs(held: DataFrame, kind: str) -> DataFrame:
    schema = (
        f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
                out: dict[str, list] = {c: [] for c in target.names}
                nodes, height = row["nodes"], row["height"]
                for index, (doc, tampered) in enumerate(zip(row["id"], row["tampered"], strict=True)):
                    lefts, rights = siblings(nodes, height, index)
                    lefts, rights = lefts + row["lefts"], rights + row["rights"]
                    own = nodes[address(height + 1, height, index)]
                    folded = fold(tampered or own, lefts, rights)
                    proof = digest(*[x for pair in zip(lefts, rights, strict=True) for x in pair])
                    values = (doc, own, row["subroot"], row["whole"], proof, folded, folded == row["whole"])
                    for column, value in zip(out.values(), values, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_pydict(out, schema=target)

    return held.mapInArrow(run, schema)
