"""Codes and clusters of vectors against plain versions in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from sitelattice.llm import clustering, codes, whole

NAN, INF = float("nan"), float("inf")


def distance(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def nearest(x, centers):
    return min((distance(x, c), i) for i, c in enumerate(centers))


def floors(total, n):
    return [t // n for t in total]


def rounds_of(rows, centers, rounds):
    for _ in range(rounds):
        groups = {}
        for x in rows:
            groups.setdefault(nearest(x, centers)[1], []).append(x)
        centers = [floors([sum(c) for c in zip(*groups[i], strict=True)], len(groups[i])) if i in groups else c for i, c in enumerate(centers)]
    return centers


def quantised(v, scale):
    return [math.floor(scale * float(x)) for x in v]


def plain_clusters(rows, k, rounds, scale, length):
    kept = [(i, quantised(v, scale)) for i, v in rows if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)[:k]
    centers = rounds_of([q for _, q in kept], [q for _, q in first], rounds)
    return centers, [(i, *nearest(q, centers)[::-1]) for i, q in kept]


def plain_codes(rows, parts, entries, rounds, scale):
    kept = [(i, quantised(v, scale), label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = len(kept[0][1]) // parts
    cut = lambda q, p: q[p * size : (p + 1) * size]
    least = {}
    for i, q, _ in kept:
        if i is not None:
            least[i] = min(q, least.get(i, q))
    first = [least[i] for i in sorted(least)[:entries]]
    books = [rounds_of([cut(q, p) for _, q, _ in kept], [cut(q, p) for q in first], rounds) for p in range(parts)]
    return books, [(i, label, [nearest(cut(q, p), b) for p, b in enumerate(books)]) for i, q, label in kept]


def made(rng, n, length, grid):
    """Rows on a coarse grid, so that equal distances are common, some repeated."""
    rows = [(i, [rng.randint(-grid, grid) / 8 for _ in range(length)]) for i in range(n)]
    return rows + rng.sample(rows, n // 10)


@pytest.mark.parametrize("grid", [2, 40])
def test_clusters_are_the_plain_ones(spark, grid):
    rows = made(random.Random(grid), 150, 6, grid)
    assigned, clusters = clustering.lloyd(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5), k=5, rounds=4, scale=16, length=6)
    centers, want = plain_clusters(rows, 5, 4, 16, 6)
    assert sorted(tuple(r) for r in assigned.collect()) == sorted(want)
    found = {r["cluster"]: r for r in clusters.collect()}
    assert [found[g]["centroid"] for g in range(5)] == centers
    inertia = [sum(d for _, c, d in want if c == g) for g in range(5)]
    assert [found[g]["cluster_inertia"] for g in range(5)] == inertia and {r["inertia"] for r in found.values()} == {sum(inertia)}


@pytest.mark.parametrize("grid", [2, 40])
def test_codes_are_the_plain_ones(spark, grid):
    rng = random.Random(grid)
    rows = [(*r, rng.choice([None, 1, 2])) for r in made(rng, 120, 12, grid)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    coded, books = codes.product_codes(table, parts=3, entries=7, rounds=3, scale=16, keep=("label",))
    want_books, want = plain_codes(rows, 3, 7, 3, 16)
    assert [b.tolist() for b in books] == want_books
    got = codes.label_errors(codes.common.persist_table(coded, "codes"), "label").collect()
    total = {}
    for _, label, found in want:
        total[label] = total.get(label, 0) + sum(d for d, _ in found)
    expected = sorted((i, [e for _, e in found], sum(d for d, _ in found), total[label]) for i, label, found in want)
    assert sorted((r["id"], r["code"], r["error"], r["label_error"]) for r in got) == expected


def test_tree_keeps_the_lowest_index_of_equals_and_takes_fewer_distances():
    rng = np.random.default_rng(1)
    for trial in range(60):
        n, d, grid = int(rng.integers(1, 40)), int(rng.integers(1, 9)), int(rng.integers(1, 6))
        entries, x = rng.integers(-grid, grid + 1, (n, d)), rng.integers(-grid - 1, grid + 2, (200, d))
        at, best, _ = codes.Tree(entries).nearest(x)
        full = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (at == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all(), trial
    centers = rng.integers(-1000, 1000, (16, 8))
    x = centers[rng.integers(0, 16, 4000)] + rng.integers(-30, 30, (4000, 8))
    assert codes.Tree(centers).nearest(x)[2] < 4000 * 16 / 2


def test_large_components_are_exact():
    entries = np.array([[2**40, 5], [2**40 + 1, 5], [-(2**62), 2**62]], dtype=object)
    x = np.array([[2**40 + 1, 4], [-(2**62) + 7, 2**62]], dtype=object)
    for at, best in (codes.Tree(entries).nearest(x)[:2], clustering.nearest(x, entries)):
        assert at.tolist() == [1, 2] and best.tolist() == [1, 49]
    assert whole.as_longs(np.array([2**70, 3], dtype=object)).tolist() == [whole.LARGEST, 3]


EDGE = [
    (0, [1.0, 2.0, -0.5, 3.0], 1), (0, [1.0, 2.0, -0.5, 3.0], 1), (0, [9.0, 9.0, 9.0, 9.0], None), (1, None, 2), (2, [None, 1.0, 1.0, 1.0], 2), (3, [NAN, 1.0, 1.0, 1.0], 2),
    (4, [1.0, INF, 1.0, 1.0], 2), (None, [1.0, 1.0, 1.0, 1.0], None), (5, [], 1), (6, [1.0], 1), (2**60 + 1, [1e300, -1e300, 0.0, 1.0], None), (7, [1.0, 2.0, -0.5, 3.0], 2),
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, v, label, "x", 1, 2, "k", 3) for i, v, label in EDGE]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, q string, id int, cluster int, key string, error int")


def test_clusters_at_the_edges(spark, edges):
    assigned, clusters = clustering.lloyd(edges, k=8, rounds=3, length=4)
    rows = assigned.collect()
    assert sorted(((r["id"] is None, r["id"] or 0) for r in rows)) == [(False, 0), (False, 0), (False, 0), (False, 7), (False, 2**60 + 1), (True, 0)]
    assert all(r["distance"] >= 0 for r in rows) and clusters.count() == 5
    for table in (edges.where("false"), edges.where("embedding is null")):
        assigned, clusters = clustering.lloyd(table, length=4)
        assert assigned.columns == ["id", "cluster", "distance"] and assigned.count() == 0 and clusters.count() == 0


def test_codes_at_the_edges(spark, edges):
    coded, books = codes.product_codes(edges, parts=2, keep=("label", "key"))
    assert coded.columns == ["id", "label", "key", "code", "error"] and [len(b) for b in books] == [3, 3]
    rows = codes.label_errors(codes.common.persist_table(coded, "codes"), "label").collect()
    assert sorted(r["id"] for r in rows if r["id"] is not None) == [0, 0, 0, 7, 2**60 + 1] and {r["key"] for r in rows} == {"k"}
    assert len({r["label_error"] for r in rows if r["label"] is None}) == 1
    for table in (edges.where("false"), edges.where("embedding is null"), edges.where("size(embedding) = 1")):
        coded, books = codes.product_codes(table, parts=2, keep=("label",))
        assert coded.count() == 0 and books == [] and codes.label_errors(codes.common.persist_table(coded, "codes"), "label").count() == 0
