import hashlib
import math

import numpy as np
import pytest

from aerolake.llm import clustering as C

DIMS = 4
NAMES = "vec_id long, embedding array<double>, cluster string, vec string, label int"


def doubles(e):
    return e if e is None else [x if x is None else float(x) for x in e]


def brute(rows, k, rounds, dims):
    """Plain Lloyd's rounds in Python integers."""
    kept = [(i, e, [math.floor(x * 64) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, _, v in order[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for step in range(rounds + 1):
        own = [min(range(len(centroids)), key=lambda j: (dist(v, centroids[j]), j)) for _, _, v in kept]
        if step == rounds:
            break
        for j in range(len(centroids)):
            members = [v for (_, _, v), a in zip(kept, own) if a == j]
            if members:
                centroids[j] = [sum(c) // len(members) for c in zip(*members)]
    d = [dist(v, centroids[a]) for (_, _, v), a in zip(kept, own)]
    inertia = [sum(x for x, b in zip(d, own) if b == a) for a in range(len(centroids))]
    return sorted(((i, a, x, inertia[a], sum(d), hashlib.sha256(",".join(map(str, centroids[a])).encode()).hexdigest())
                   for (i, _, _), a, x in zip(kept, own, d)), key=str)


def found(spark, rows, k, rounds, dims=DIMS):
    df = spark.createDataFrame([(i, doubles(e), "?", "?", 1) for i, e in rows], NAMES)
    return sorted(map(tuple, C.clusters(df, k, rounds, dims).collect()), key=str)


def test_awkward_rows(spark):
    inf, nan = math.inf, math.nan
    rows = [(1, [0.0] * 4), (1, [0.0] * 4), (2, [1.0, 2, 3, 4]), (3, None), (4, []), (5, [1.0] * 5), (6, [1.0, nan, 0, 0]),
            (7, [1.0, inf, 0, 0]), (8, [1.0, None, 0, 0]), (None, [3.0, 3, 3, 3]), (9, [-0.01, -1.5, 0.3, 0.001]), (1, [9.0, 9, 9, 9]),
            (10, [1e7, -1e7, 0, 0]), (11, [1e7 + 1, -1e7, 0, 0])] + [(20 + i, [i % 3, i % 5, -i, 0.5 * i]) for i in range(30)]
    for k, rounds in ((1, 2), (3, 0), (5, 3), (60, 2)):
        assert found(spark, rows, k, rounds) == brute(rows, k, rounds, DIMS)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(x), 0, 0, 0]) for i, x in enumerate([0, 2, 1, 1, 1, 3, 4, 0, 2])]
    assert found(spark, rows, 4, 3) == brute(rows, 4, 3, DIMS)


def test_empty(spark):
    df = spark.createDataFrame([], NAMES)
    out = C.clusters(df)
    assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_huge_components_give_null_distances(spark):
    df = spark.createDataFrame([(1, [1e12] * 4, "?", "?", 1), (2, [-1e12] * 4, "?", "?", 1), (3, [0.0] * 4, "?", "?", 1)], NAMES)
    rows = C.clusters(df, 1, 1, 4).collect()
    assert len(rows) == 3 and all(r["inertia"] is None for r in rows)


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 3, (12, 8))
    return [(i, (centres[i % 12] + rng.normal(0, 0.35, 8)).tolist()) for i in range(1500)]


def test_tighter_bounds_scan_less_and_change_nothing(spark, blobs):
    df = spark.createDataFrame([(i, e, "?", "?", 1) for i, e in blobs], NAMES)
    runs = [C.cluster_vectors(df, 12, 6, 8, tighten=t) for t in (True, False)]
    rows = [sorted(map(tuple, r[0].collect())) for r in runs]
    assert rows[0] == rows[1] and runs[0][1:3] == runs[1][1:3]
    tight, full = sum(runs[0][3]), sum(runs[1][3])
    assert tight < full < 7 * len(blobs)
    assert sorted(found(spark, blobs, 12, 6, 8)) == sorted(brute(blobs, 12, 6, 8))


def test_loosening_covers_every_point_of_the_sphere():
    rng = np.random.default_rng(3)
    for _ in range(200):
        old, new = rng.integers(-50, 50, (3, 5)), rng.integers(-50, 50, (3, 5))
        radius = rng.uniform(0, 60, 3)
        bound = C.loosening(old.tolist(), new.tolist(), radius.tolist())
        drift = C.loosening(old.tolist(), new.tolist(), radius.tolist(), tighten=False)
        x = rng.normal(size=(500, 5))
        x *= rng.uniform(0, 1, (500, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
        for i in range(3):
            points = old[i] + radius[i] * x
            nearer = max((np.linalg.norm(points - old[j], axis=1) - np.linalg.norm(points - new[j], axis=1)).max() for j in range(3) if j != i)
            assert nearer <= bound[i] + 1e-9 and bound[i] <= drift[i] + 1e-9


def test_sql(spark, duck):
    got = sorted(map(tuple, C.clusters(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")).collect()))
    assert got == sorted(duck("/root/testdata/sf0.001").execute(C.SQL).fetchall())
