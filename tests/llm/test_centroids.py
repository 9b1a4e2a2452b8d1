import hashlib
import math

import numpy as np
import pytest

from siteledger.llm.centroids import Simplex, bounds, cluster, nearest


def plain(rows, clusters=16, rounds=3, size=64):
    """rows of (id, vector): every distance in Python integers."""
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        own = [k for _, k in assign()]
        groups = [[v for (_, v), k in zip(kept, own) if k == j] for j in range(len(centroids))]
        centroids = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centroids)]
    found = assign()
    inertia = [sum(d for d, k in found if k == j) for j in range(len(centroids))]
    named = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def fit(n):
        return n if n < 1 << 63 else None

    return sorted(((i, k, fit(d), fit(inertia[k]), fit(sum(inertia)), named[k]) for (i, _), (d, k) in zip(kept, found)), key=repr)


def run(spark, rows, kind="float", **options):
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 AS _v", "2 AS cluster", "3 AS _id")
    return sorted((tuple(r) for r in cluster(table, **options).collect()), key=repr)


def drawn(n, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(rng.normal(0, spread, (n, 64)))]


def test_against_plain_integers(spark):
    rows = drawn(300, 1)
    assert run(spark, rows) == plain(rows)


def test_unfit_vectors_leave_and_repeats_and_ties_count(spark):
    rows = drawn(40, 2)
    same = [0.25] * 64
    rows += [(100, same)] * 60 + [(None, same), (None, [-0.01] * 64), (7, [0.5] * 64), (7, [-0.5] * 64)]
    rows += [(200, None), (201, []), (202, [0.1] * 63), (203, [0.1] * 65), (204, [0.1] * 63 + [None]), (205, [math.nan] * 64), (206, [0.1] * 63 + [math.inf])]
    found = run(spark, rows)
    assert found == plain(rows) and len(found) == 104


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, n):
    rows = drawn(n, 3)
    assert run(spark, rows) == plain(rows)


def test_components_of_any_size(spark):
    rows = drawn(30, 4) + [(50 + i, [s * 10.0**e] * 64) for i, (s, e) in enumerate([(1, 6), (-1, 9), (1, 12), (3, 37), (-1, 37)])]
    rows += [(80 + i, [9e18 if i % 2 else -9e18] * 64) for i in range(4)]
    assert run(spark, rows, "double", clusters=4) == plain(rows, 4)
    assert {r[2] is None for r in plain(rows, 4)} == {True, False}


def test_integers_of_equal_distance_go_to_the_smaller_number(spark):
    rows = [(i, [float(x)] + [0.0] * 63) for i, x in enumerate([0, 2, 1, 1, 1, 4, 3])]
    assert run(spark, rows, clusters=3, rounds=2) == plain(rows, 3, 2)


def test_bounds_hold_and_spare_distances_of_planted_clusters():
    rng = np.random.default_rng(5)
    centres = rng.integers(-60, 60, (16, 64))
    points = (centres[rng.integers(0, 16, 2000)] + rng.integers(-4, 5, (2000, 64))).astype(float)
    simplex = Simplex.of(centres.astype(float), 12)
    moved = [list(map(int, c + rng.integers(-2, 3, 64))) for c in centres]
    apexes = simplex.apexes(points)
    low, high = bounds(apexes, simplex.apexes(np.array(moved, float)))
    true = np.sqrt(((points[:, None] - np.array(moved)[None]) ** 2).sum(axis=2))
    assert (low <= true + 1e-6).all() and (true <= high + 1e-6).all()
    which, distances, asked = nearest(points, apexes, moved, simplex)
    assert (which == true.argmin(axis=1)).all() and distances == [int(d) for d in np.rint(true.min(axis=1) ** 2)]
    assert asked < 0.15 * 16 * 2000


def test_pivots_that_add_no_dimension_are_left_out():
    base = np.zeros((5, 64))
    base[1, 0], base[2, 0], base[3, 1], base[4, :2] = 10, 20, 10, 5
    assert len(Simplex.of(base, 5).pivots) == 3
    assert len(Simplex.of(np.zeros((4, 64)), 4).pivots) == 1
