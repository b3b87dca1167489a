"""Whitening, the Merkle manifest and shards against plain versions, and their awkward cases."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthwatt.llm import merkle, ordering, sharding, spectrum, whitening
from hearthwatt.llm.queries import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"


# Whitening


def test_polynomial_is_exact():
    matrix = [[2, 1, 0], [1, 2, 1], [0, 1, 2]]
    assert spectrum.characteristic_polynomial(matrix) == [-4, 10, -6, 1]
    large = 10**30
    assert spectrum.characteristic_polynomial([[large, 1], [1, large]]) == [large * large - 1, -2 * large, 1]
    # A zero below the diagonal makes the reduction swap rows.
    assert spectrum.characteristic_polynomial([[1, 0, 2], [0, 3, 4], [2, 4, 5]]) == [-(15 - 16) + 12, 3 + 5 + 15 - 16 - 4, -9, 1]


def test_roots_with_multiplicities():
    found = spectrum.components_of(np.diag([5, 5, 5, 3, 3, 1, 0, 0]).tolist(), 8)
    assert [value for value, _ in found] == [5, 5, 5, 3, 3, 1]
    vectors = np.array([v for _, v in found])
    assert np.abs(vectors @ vectors.T - np.eye(6)).max() < 1e-15


def test_components_beyond_doubles():
    """Eigenvalues that doubles cannot tell apart still get their own vectors."""
    large = 10**20
    found = spectrum.components_of([[large, 1], [1, large]], 2)
    assert np.allclose(np.abs(np.array([v for _, v in found])), np.sqrt(0.5), atol=1e-15)
    assert found[0][1].prod() > 0 > found[1][1].prod()


def test_op11(spark):
    rows = QUERIES["op11_exact_whitening"](spark, SF_DIR).toPandas()
    vectors = {r["vec_id"]: np.floor(64 * np.array(r["embedding"], float)).astype(int) + 1_000_000 for r in table(spark, SF_DIR, "embeddings").collect()}
    fit = np.array(sorted({tuple(map(int, x)) for x in vectors.values()}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    assert set(rows.n) == {n} and len(rows) == 16 * len(vectors)
    for r in rows[rows.component == 1].itertuples():
        assert r.deviation == ((n * vectors[r.vec_id].astype(object) - sums) ** 2).sum()
    centred = (fit - sums / n).astype(float)
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1][:16], components[:, ::-1][:, :16]
    wide = rows.pivot(index="vec_id", columns="component", values="whitened")
    plain = np.array([(vectors[i] - (sums / n).astype(float)) @ components / np.sqrt(values) for i in wide.index])
    signs = np.sign((plain * wide.values).sum(axis=0))
    assert np.abs(plain * signs - wide.values).max() < 1e-9
    assert np.allclose(rows[rows.vec_id == wide.index[0]].sort_values("component").explained, values / np.trace(centred.T @ centred / n))
    assert rows.identity_error.nunique() == 1 and rows.identity_error[0] < 1e-9


@pytest.mark.parametrize("n", [3, 10**5, 10**8, 10**10, 10**17])
def test_squares_are_exact(n):
    """Whatever the number of vectors, also where 64 bits do not hold a sum of squares."""
    x = np.random.default_rng(0).integers(-70, 70, (50, 64))
    x[0], x[1, :], x[1, 0] = 0, 0, 1
    sums = [int(v) for v in x.sum(axis=0)]
    wanted = [sum((int(v) * n - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    assert whitening._squares(whitening._deviations(x, n, sums)) == [v if v < 1 << 63 else None for v in wanted]


def test_whitening_awkward(spark):
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.001, 2.0]), (None, [0.5, 1.0]), (3, None),
        (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, []), (7, [1.0]), (8, [float("inf"), 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS x", "2 AS id", "3 AS n")
    found = whitening.whiten(df).collect()
    # Three rows are one integer vector: the fit list has two, and one direction of variance.
    assert Counter(r["vec_id"] for r in found) == {1: 2, 2: 1, None: 1}
    assert {(r["n"], r["component"]) for r in found} == {(2, 1)}
    assert all(abs(abs(r["whitened"]) - 1) < 1e-12 and r["explained"] == 1 for r in found)
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id <= 2")).count() == 0
    huge = spark.createDataFrame([(1, [1e300]), (2, [-1e300])], "vec_id long, embedding array<double>")
    assert sorted(r["whitened"] for r in whitening.whiten(huge).collect()) == [-1, 1]


# Merkle manifest


def plain_manifest(rows):
    def h(*parts):
        return sha256("".join(parts).encode()).hexdigest()

    def coded(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(r, text):
        return h(*map(coded, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))

    def levels_of(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
        return out

    def way(levels, i):
        out = []
        for nodes in levels[:-1]:
            out.append((nodes[i // 3 * 3 : i], nodes[i + 1 : i // 3 * 3 + 3]))
            i //= 3
        return out

    sources = defaultdict(list)
    for r in rows:
        sources[r["source"]].append((leaf(r, r["text"]), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        held = sorted(sources[s], key=lambda x: (x[1]["doc_id"] is not None, x[1]["doc_id"] or 0, x[0]))
        trees.append((held, levels_of([x[0] for x in held])))
    top = levels_of([levels[-1][0] for _, levels in trees])
    out = []
    for k, (held, levels) in enumerate(trees):
        for i, (own, r) in enumerate(held):
            steps, text = way(levels, i) + way(top, k), r["text"]
            if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(r, text)
            for left, right in steps:
                node = h(*left, node, *right)
            proof = h(*[x for left, right in steps for x in left + right])
            out.append((r["doc_id"], own, levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def same(found, rows):
    key = lambda r: (r[0] is not None, *r[:1], *r[1:]) if r[0] is not None else (False, 0, *r[1:])
    assert sorted(map(tuple, found), key=key) == sorted(plain_manifest(rows), key=key)


def test_van_emde_boas_addresses():
    """A permutation of all places; each lower subtree of half the height is contiguous."""
    for levels in range(1, 7):
        places = [merkle.address(levels, d, i) for d in range(levels) for i in range(3**d)]
        assert sorted(places) == list(range((3**levels - 1) // 2))
    size = (3**4 - 1) // 2
    for tree in range(3**3):
        places = [merkle.address(7, 3 + d, tree * 3**d + i) for d in range(4) for i in range(3**d)]
        assert sorted(places) == list(range((3**3 - 1) // 2 + tree * size, (3**3 - 1) // 2 + (tree + 1) * size))


@pytest.mark.parametrize("height", [1, 2, 6])
def test_op12_in_blocks_of_any_height(spark, height):
    df = table(spark, SF_DIR, "documents")
    found = merkle.merkle_manifest(df, height=height).collect()
    same(found, [r.asDict() for r in df.collect()])
    assert 0 < sum(not r["verified"] for r in found) < len(found)


def test_merkle_hot_source_in_many_ranges(spark, monkeypatch):
    """A source that fills most ranges of the order, and many small ones."""
    monkeypatch.setattr(ordering, "LEAST_ROWS", 10)
    df = table(spark, SF_DIR, "documents").withColumn("source", F.expr("CASE WHEN doc_id % 3 > 0 THEN 'hot' WHEN doc_id % 2 > 0 THEN concat('s', doc_id) END"))
    same(merkle.merkle_manifest(df, height=2).collect(), [r.asDict() for r in df.collect()])


def test_merkle_awkward(spark, awkward, empty):
    same(merkle.merkle_manifest(awkward.withColumn("tree", F.lit(1)).withColumn("block", F.lit(2))).collect(), [r.asDict() for r in awkward.collect()])
    assert merkle.merkle_manifest(empty).count() == 0
    lone = awkward.where("doc_id = 4")
    (row,) = merkle.merkle_manifest(lone).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha256(b"").hexdigest()


# Shards


def test_tree_finds_the_tightest():
    rng, tree, keys = np.random.default_rng(0), sharding.Tree(), set()
    for _ in range(2000):
        key = (int(rng.integers(50)), int(rng.integers(50)))
        if key in keys:
            tree.remove(key)
            keys.discard(key)
        else:
            tree.add(key)
            keys.add(key)
        wanted = (int(rng.integers(50)),)
        assert tree.first_from(wanted) == min((k for k in keys if k >= wanted), default=None)


def plain_best_fit(weights, capacity):
    rooms, out = [], []
    for w in sorted(weights, reverse=True):
        fitting = [(room, k) for k, room in enumerate(rooms) if room >= w]
        if fitting:
            k = min(fitting)[1]
        else:
            rooms.append(capacity)
            k = len(rooms) - 1
        rooms[k] -= w
        out.append((w, k))
    return out


def test_runs_equal_one_group_at_a_time():
    rng = np.random.default_rng(1)
    for _ in range(200):
        weights = rng.integers(1, 60, rng.integers(1, 80)).tolist()
        runs = sharding.best_fit_decreasing(sorted(Counter(weights).items(), reverse=True), 100, len(weights))
        assert [(size, b) for size, _, n, b in runs for _ in range(n)] == plain_best_fit(weights, 100)


def shards_of(df, shards=40):
    rows = sharding.shard_documents(df, shards).collect()
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in df.select("doc_id", "text").collect()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((d, len(t) + 16, zlib.crc32(t)) for d, t in texts)
    sizes, slots, groups = Counter(), defaultdict(list), {}
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert groups.setdefault((r["size"], r["text_crc32"]), r["shard"]) == r["shard"]
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_op13(spark):
    sizes = shards_of(table(spark, "/root/testdata/sf0.01", "documents"))
    assert len(sizes) == 40 and max(sizes.values()) < 1.01 * min(sizes.values())


def test_shards_with_a_hot_group(spark, monkeypatch):
    """A third of all rows are one text: it has a shard of its own, the others are equal."""
    monkeypatch.setattr(sharding, "ROWS_AT_ONCE", 50)
    rows = [(i, "the same text " * 20) for i in range(500)] + [(1000 + i, f"text {i} " + "x" * (i % 97)) for i in range(1000)]
    sizes = shards_of(spark.createDataFrame(rows, "doc_id long, text string"), 10)
    largest, *others = sorted(sizes.values(), reverse=True)
    assert largest == 500 * 296 and len(others) == 9 and max(others) - min(others) < 300


def test_hot_groups_beside_others(spark, monkeypatch):
    """Some groups are broadcast, the others shuffled: each row meets its group once."""
    monkeypatch.setattr(sharding, "HOT_SHARE", 0.1)
    rows = [(i, f"copy of {i % 3}") for i in range(600)] + [(1000 + i, f"text {i // 2}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(shards_of(df, 5)) == 5


def test_shards_awkward(spark, awkward, empty):
    assert len(shards_of(awkward.selectExpr("*", "1 AS row", "2 AS shard", "3 AS size"))) <= 9
    assert len(shards_of(awkward, 1)) == 1
    assert sharding.shard_documents(empty).count() == 0
