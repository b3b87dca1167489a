"""Approximate nearest neighbours by inner product, on a graph built by NN-descent.

The graph starts from exact neighbours within small blocks of a few random orders. Each round
then lets every vector introduce its neighbours to each other, and keeps the best for each.
Queries walk the graph greedily from their own vector, expanding the best known ones.

Equal vectors are one vertex: its graph has no ties, and their ids follow from a list.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hearthwatt.llm.frames import find_package, stored

#: Neighbours of a vertex in the graph.
DEGREE = 32
#: Links of a vertex that meet in a round, in each direction; new ones come first.
SAMPLE = 24
#: Rounds of NN-descent go on until fewer than this share of all links have not met yet.
SETTLED = 0.05
#: Random orders the graph starts from, and rows of a block.
ORDERS, BLOCK = 6, 512
#: An order puts vectors with the same nearest pivot together. Pivots are rows chosen by hash:
#: one for so many vectors, within these bounds.
VECTORS_PER_PIVOT, LEAST_PIVOTS, MOST_PIVOTS = 2048, 16, 4096
#: Best vertices a query remembers, and those it expands at once.
BEAM, EXPANDED = 160, 80

LINK = "a long, b long, near float, fresh boolean"


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of rows whose vector is not null, empty or zero, with finite
    components only, and whose id is not null."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(id_col).isNotNull() & fine & F.exists(v, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("id"), v.alias("v")
    )


def _run(df: DataFrame, function, schema: str) -> DataFrame:
    """Apply ``function`` to whole Arrow batches as (names -> lists); it yields such dicts."""
    find_package(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in function(batches):
            yield pa.RecordBatch.from_pydict(out, schema=target)

    return df.mapInArrow(run, schema)


def _floats(column: pa.Array, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1) if rows else np.zeros((0, 1), kind)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key in turn, of rows sorted by it; each group is small by design."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(a, b - a)
            if held and held[-1].column(key)[0].as_py() != part.column(key)[0].as_py():
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _start(nodes: DataFrame, chosen: np.ndarray, degree: int, tasks: int) -> DataFrame:
    """Exact neighbours within blocks of vectors that follow each other in one of several orders: by
    nearest pivot of that order, then by a random projection. All orders share one shuffle."""
    orders = []
    for order in range(ORDERS):
        pivots = chosen[order::ORDERS] if len(chosen) >= ORDERS else chosen
        orders.append((pivots, np.random.default_rng(order).standard_normal(chosen.shape[1]).astype(np.float32)))

    def sort_keys(batches):
        for batch in batches:
            v = _floats(batch.column("raw"), "<f4")
            for order, (pivots, line) in enumerate(orders):
                cell = (v @ pivots.T).argmax(axis=1)
                key = cell + 1 / (1 + np.exp(-(v @ line).astype(np.float64)))
                ways = np.full(len(key), order)
                yield {"node": batch.column("node"), "raw": batch.column("raw"), "way": ways, "key": key}

    def meet(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            ways = batch.column("way").to_numpy()
            cuts = [0, *(np.flatnonzero(ways[1:] != ways[:-1]) + 1).tolist(), len(ways)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                for start in range(a, b, BLOCK):
                    if held and held[-1].column("way")[0].as_py() != ways[start]:
                        yield block(held)
                        held, rows = [], 0
                    held.append(batch.slice(start, min(BLOCK, b - start)))
                    rows += held[-1].num_rows
                    if rows >= BLOCK:
                        yield block(held)
                        held, rows = [], 0
        if held:
            yield block(held)

    def block(held):
        table = pa.Table.from_batches(held)
        ids, v = table["node"].to_numpy(), _floats(table["raw"], "<f4")
        near = v @ v.T
        np.fill_diagonal(near, -np.inf)
        k = min(degree, len(ids) - 1)
        best = np.argpartition(-near, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(ids), 0), int)
        rows = np.repeat(np.arange(len(ids)), best.shape[1])
        found = near[rows, best.ravel()]
        return {"a": ids[rows], "b": ids[best.ravel()], "near": found, "fresh": np.ones(len(found), bool)}

    keyed = _run(nodes.select("node", "raw"), sort_keys, "node long, raw binary, way long, key double")
    dealt = keyed.repartitionByRange(tasks, "way", "key").sortWithinPartitions("way", "key")
    return _run(dealt, meet, LINK)


def _mixed(*parts) -> np.ndarray:
    """Pseudo-random numbers in [0, 1) that depend on the arguments alone."""
    x = np.zeros(1, np.uint64)
    for part in parts:
        x = (x ^ np.asarray(part).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        x = x ^ (x >> np.uint64(29))
    return (x * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(11)) / float(1 << 53)


def _best(links: DataFrame, degree: int, round_number: int) -> DataFrame:
    """For each vertex its best links, as one row of arrays, with those that meet next. A link
    that has met before is no longer fresh."""

    def take(group):
        node, b, near, fresh = (group[c].to_numpy() for c in ("a", "b", "near", "fresh"))
        order = np.lexsort((fresh, b))
        b, near, fresh = b[order], near[order], fresh[order]
        first = np.concatenate([[True], b[1:] != b[:-1]])
        b, near, fresh = b[first], near[first], fresh[first]
        order = np.lexsort((b, -near))[:degree]
        b, near, fresh = b[order], near[order], fresh[order]
        met = np.argsort(_mixed(node[0], b, round_number) - fresh, kind="stable")[:SAMPLE]
        after = fresh.copy()
        after[met] = False
        return {"node": node[0], "others": b, "near": near, "fresh": after, "met": b[met], "met_fresh": fresh[met]}

    def several(batches):
        held = []
        for group in _groups(batches, "a"):
            held.append(take(group))
            if len(held) == 512:
                yield {c: [h[c] for h in held] for c in held[0]}
                held = []
        if held:
            yield {c: [h[c] for h in held] for c in held[0]}

    ordered = links.select("a", "b", "near", "fresh").repartition("a").sortWithinPartitions("a")
    schema = (
        "node long, others array<long>, near array<float>, fresh array<boolean>, "
        "met array<long>, met_fresh array<boolean>"
    )
    return _run(ordered, several, schema)


def _trimmed(a: np.ndarray, b: np.ndarray, near: np.ndarray, fresh: np.ndarray, degree: int) -> dict:
    """Links without those that can't be among the best of their vertex, so that a vertex that many
    introduce sends few rows to its reducer."""
    # Of equal pairs one that has met comes first and is kept.
    order = np.lexsort((fresh, b, a))
    a, b, near, fresh = a[order], b[order], near[order], fresh[order]
    once = np.ones(len(a), bool)
    once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, near, fresh = a[once], b[once], near[once], fresh[once]
    order = np.lexsort((b, -near, a))
    a, b, near, fresh = a[order], b[order], near[order], fresh[order]
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, int)
    rank = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))
    good = rank < degree
    return {"a": a[good], "b": b[good], "near": near[good], "fresh": fresh[good]}


def _meet(graph: DataFrame, nodes: DataFrame, degree: int) -> DataFrame:
    """One round of NN-descent: all pairs among a vertex's sampled neighbours, in both
    directions, of which one is fresh and that are better than the worst link known so far."""
    pairs = graph.select(F.col("node").alias("v"), F.explode(F.arrays_zip("met", "met_fresh")).alias("x"))
    forward = pairs.select("v", F.col("x.met").alias("a"), F.col("x.met_fresh").alias("fresh"))
    by_chance = Window.partitionBy("v").orderBy(F.desc("fresh"), F.xxhash64("a", "v"), "a")
    backward = (
        forward.select(F.col("a").alias("v"), F.col("v").alias("a"), "fresh")
        .withColumn("rank", F.row_number().over(by_chance))
        .where(F.col("rank") <= SAMPLE)
        .drop("rank")
    )
    worst = graph.select(F.col("node").alias("a"), F.array_min("near").alias("worst"))
    known = stored(nodes.select(F.col("node").alias("a"), "half").join(worst, "a"), "known")
    members = forward.union(backward).join(known, "a")

    def introduce(batches):
        for group in _groups(batches, "v"):
            ids, worst, fresh = (group[c].to_numpy() for c in ("a", "worst", "fresh"))
            order = np.lexsort((~fresh, ids))
            order = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]
            ids, worst, fresh = ids[order], worst[order], fresh[order]
            if not fresh.any():
                continue
            v = _floats(group["half"], "<f2")[order].astype(np.float32)
            near = v @ v.T
            np.fill_diagonal(near, -np.inf)
            one, other = np.nonzero((near > worst[:, None]) & (fresh[:, None] | fresh[None, :]))
            yield ids[one], ids[other], near[one, other], np.ones(len(one), bool)

    def several(batches):
        held, rows = [], 0
        for part in introduce(batches):
            held.append(part)
            rows += len(part[0])
            if rows > 100_000:
                yield _trimmed(*map(np.concatenate, zip(*held, strict=True)), degree)
                held, rows = [], 0
        if held:
            yield _trimmed(*map(np.concatenate, zip(*held, strict=True)), degree)

    ordered = members.select("v", "a", "fresh", "half", "worst").repartition("v").sortWithinPartitions("v")
    return _run(ordered, several, LINK)


def neighbour_graph(nodes: DataFrame, degree: int = DEGREE, settled: float = SETTLED) -> DataFrame:
    """``node`` and ``others`` by NN-descent, whose rounds end when the graph has settled: when
    fewer than the share ``settled`` of its links are new. That share is the same for any number
    of vectors. Values are compared on 16-bit floats; ``near`` is for building only."""
    vertices = nodes.count()
    count = min(MOST_PIVOTS, max(LEAST_PIVOTS, vertices // VECTORS_PER_PIVOT))
    # A task's last block may be short, so a task gets a few.
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = ORDERS * max(1, min(tasks, vertices // (2 * BLOCK)))
    by_hash = nodes.select("raw", F.xxhash64("node", F.lit("pivot")).alias("key")).orderBy("key")
    chosen = np.array([np.frombuffer(r["raw"], "<f4") for r in by_hash.limit(count * ORDERS).collect()])
    links = _start(nodes, chosen, degree, tasks) if len(chosen) else nodes.sparkSession.createDataFrame([], LINK)
    graph = stored(_best(links, degree, 0), "graph")
    number = 0
    while _unmet(graph) >= settled:
        number += 1
        old = graph.select(F.col("node").alias("a"), F.explode(F.arrays_zip("others", "near", "fresh")).alias("x"))
        old = old.select("a", F.col("x.others").alias("b"), F.col("x.near").alias("near"), F.col("x.fresh").alias("fresh"))
        graph = stored(_best(old.union(_meet(graph, nodes, degree)), degree, number), "graph")
    return graph


def _unmet(graph: DataFrame) -> float:
    """The share of links that were new when their round began."""
    fresh = lambda c: F.size(F.filter(c, lambda x: x))
    found = graph.agg(F.sum(fresh("fresh") + fresh("met_fresh")).alias("new"), F.sum(F.size("others")).alias("all")).first()
    return (found["new"] or 0) / (found["all"] or 1)


def _walk(queries: DataFrame, graph: DataFrame, nodes: DataFrame, beam: int) -> DataFrame:
    """Greedy search: pairs of ``q`` and one of its ``beam`` best vertices, by 16-bit floats.

    A vertex's links are walked both ways. Each step expands the best unexpanded vertices of
    every query at once; vertices a query has met are not fetched again. A query ends when all
    of its best vertices are expanded, which it must, as it expands no vertex twice. Later steps
    neither read nor write a query that has ended.
    """
    forward = graph.select("node", F.explode("others").alias("w"))
    by_chance = Window.partitionBy("node").orderBy(F.xxhash64("w", "node"), "w")
    backward = forward.select(F.col("w").alias("node"), F.col("node").alias("w"))
    backward = backward.withColumn("rank", F.row_number().over(by_chance)).where(F.col("rank") <= DEGREE)
    links = forward.union(backward.drop("rank")).groupBy("node").agg(F.collect_set("w").alias("ws"))
    links = stored(links, "links")
    vectors = nodes.select(F.col("node").alias("w"), F.col("half").alias("wv"))
    schema = "q long, qv binary, met array<long>, beam array<long>, score array<double>, open array<long>"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def step(key: tuple, state: pa.Table, found: pa.Table) -> pa.Table:
        if not state.num_rows:
            return target.empty_table()
        row = state.slice(0, 1).to_pylist()[0]
        ids, score = np.array(row["beam"], np.int64), np.array(row["score"], np.float64)
        fresh = {i: x for i, x in zip(found["w"].to_pylist(), found["wv"].to_pylist(), strict=True)}
        qv = np.frombuffer(row["qv"], "<f4")
        if fresh:
            new = np.frombuffer(b"".join(fresh.values()), "<f2").reshape(len(fresh), -1).astype(np.float32) @ qv
            ids, score = np.append(ids, list(fresh)), np.append(score, new)
        order = np.lexsort((ids, -score))[:beam]
        ids, score = ids[order], score[order]
        was_open = set(row["open"]) | set(fresh)
        just = set(row["open"][:EXPANDED])
        left = [int(i) for i in ids if int(i) in was_open and int(i) not in just]
        met = row["met"] + list(fresh)
        out = {"q": [row["q"]], "qv": [row["qv"]], "met": [met], "beam": [ids], "score": [score], "open": [left]}
        return pa.Table.from_pydict(out, schema=target)

    state = queries.select(
        F.col("node").alias("q"),
        F.col("asking").alias("qv"),
        F.array("node").alias("met"),
        F.array().cast("array<long>").alias("beam"),
        F.array().cast("array<double>").alias("score"),
        F.array("node").alias("open"),
    )
    going, ended = stored(state, "walk"), []
    while not going.isEmpty():
        ahead = going.select("q", F.explode(F.slice("open", 1, EXPANDED)).alias("node"))
        reached = ahead.join(links, "node").groupBy("q").agg(F.flatten(F.collect_list("ws")).alias("ws"))
        new = going.select("q", "met").join(reached, "q").select("q", F.explode(F.array_except("ws", "met")).alias("w"))
        found = new.join(vectors, "w").withColumnRenamed("q", "asker").groupBy("asker")
        state = stored(going.groupBy("q").cogroup(found).applyInArrow(step, schema), "walk")
        going = state.where(F.size("open") > 0)
        ended.append(state.where(F.size("open") == 0))
    return reduce(DataFrame.union, ended, going).select("q", F.explode("beam").alias("w"))


def nearest(
    df: DataFrame,
    top: int = 20,
    every: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    degree: int = DEGREE,
    settled: float = SETTLED,
    beam: int = BEAM,
) -> DataFrame:
    """For each usable row whose id is divisible by ``every``: its ``top`` nearest other rows
    found, as ``query_id``, ``rank``, ``vec_id`` and ``score``, the inner product in doubles.

    Vectors that are null, zero or have null or non-finite components take no part. Equal
    vectors tie, and the smaller id comes first; rows of one id count once. Fewer rows than
    ``top`` give all of them; an empty table gives none. Vectors must have one length.

    Inner products of vectors of different lengths are no measure of nearness to each other,
    so the graph is built with one more component that gives all vectors the same length; a
    query has zero there, which leaves its inner products as they are.
    """
    rows = stored(usable(df, id_col, vector_col).dropDuplicates(["id"]), "vectors")
    first = rows.select(F.size("v").alias("n"), (F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("square"))
    bound = first.agg(F.max("square").alias("most"), F.max("n").alias("n"), F.min("n").alias("least")).first()
    size = bound["n"] or 1
    if bound["n"] != bound["least"]:
        raise ValueError("vectors differ in length")
    most = bound["most"] or 1.0

    ranked = Window.partitionBy("v").orderBy("id")
    copies = rows.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= top + 1)
    classes = copies.groupBy("v").agg(F.min("id").alias("node"), F.array_sort(F.collect_list("id")).alias("ids"))

    def encode(batches):
        for batch in batches:
            exact = np.array(batch.column("v").to_pylist(), np.float64).reshape(batch.num_rows, size)
            rest = np.sqrt(np.maximum(0.0, most - (exact * exact).sum(axis=1)))
            raw = np.column_stack([exact, rest]) / np.sqrt(most)
            yield {
                "node": batch.column("node"),
                "ids": batch.column("ids"),
                "exact": [x.tobytes() for x in exact.astype("<f8")],
                "raw": [x.tobytes() for x in raw.astype("<f4")],
                "asking": [x.tobytes() for x in np.column_stack([exact, 0 * rest]).astype("<f4")],
                "half": [x.tobytes() for x in raw.astype("<f2")],
            }

    schema = "node long, ids array<long>, exact binary, raw binary, asking binary, half binary"
    nodes = stored(_run(classes, encode, schema), "nodes")
    graph = neighbour_graph(nodes, degree, settled)

    asked = stored(
        rows.where(F.col("id") % every == 0).join(classes.select("v", "node"), "v").select("id", "node"), "asked"
    )
    starts = nodes.join(asked.select("node").distinct(), "node", "left_semi")
    walked = _walk(starts, graph, nodes, beam)
    own = starts.select(F.col("node").alias("q"), F.col("node").alias("w"))
    exact = nodes.select(F.col("node").alias("w"), F.col("exact").alias("wv"))
    pairs = walked.union(own).join(exact, "w").join(exact.toDF("q", "qv"), "q")

    def measure(batches):
        for batch in batches:
            one, other = _floats(batch.column("qv"), "<f8"), _floats(batch.column("wv"), "<f8")
            score = (one.reshape(len(one), -1) * other.reshape(len(other), -1)).sum(axis=1)
            yield {"q": batch.column("q"), "w": batch.column("w"), "score": score}

    found = _run(pairs.select("q", "w", "qv", "wv"), measure, "q long, w long, score double")
    listed = found.join(nodes.select(F.col("node").alias("w"), "ids"), "w")
    listed = listed.select("q", "score", F.explode("ids").alias("vec_id"))
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= top + 1)
    lists = listed.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("list"))
    # A query's own row goes, after which at least top are left of top + 1.
    answers = asked.join(lists, F.col("node") == F.col("q"))
    others = F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("id")), 1, top)
    return answers.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "x")).select(
        "query_id",
        (F.col("at") + 1).alias("rank"),
        F.col("x.vec_id").alias("vec_id"),
        F.col("x.score").alias("score"),
    )
