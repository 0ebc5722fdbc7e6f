import math

import numpy as np
import pytest

from aerolake.llm import neighbours as N

NAMES = "vec_id long, embedding array<double>, label int, row string, cell string, q string"


def frame(spark, rows):
    return spark.createDataFrame([(i, doubles(e), 1, "?", "?", "?") for i, e in rows], NAMES)


def doubles(e):
    return e if e is None else [x if x is None else float(x) for x in e]


def brute(rows, top=20, step=20):
    kept = [(i, list(map(float, e))) for i, e in rows if e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    out = []
    for n, (i, e) in enumerate(kept):
        if i is None or i % step:
            continue
        near = sorted((-_score(e, o), j is None, j or 0, j) for m, (j, o) in enumerate(kept) if m != n)[:top]
        out += [(i, r + 1, j, -s) for r, (s, _, _, j) in enumerate(near)]
    return sorted(out, key=str)


def _score(a, b):
    s = 0.0
    for x, y in zip(a, b):
        s += x * y
    return s


def found(spark, rows, **kw):
    return sorted(map(tuple, N.nearest(frame(spark, rows), **kw).collect()), key=str)


def test_awkward_rows(spark):
    rows = [(0, [1.0, 2, 3]), (20, [1.0, 2, 3]), (20, [1.0, 2, 3]), (20, [3.0, 2, 1]), (1, None), (2, []), (3, [0.0, 0, 0]), (4, [1.0, None, 2]),
            (40, [math.nan, 1, 2]), (5, [math.inf, 1, 2]), (None, [5.0, 5, 5]), (6, [1.0]), (7, [1.0, 1, 1, 9]), (8, [-1.0, -2, -3]), (60, [2.0, 1])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, top=2) == brute(rows, 2)


def test_copies_and_ties(spark):
    """A third of the rows is one vector; queries among them, and equal scores of other vectors."""
    rng = np.random.default_rng(1)
    rows = [(i, [0.6, 0.8, 0.0, 0.0]) for i in range(0, 200, 2)] + [(i, rng.integers(-2, 3, 4).tolist()) for i in range(1, 400, 2)]
    rows = [(i, list(map(float, e))) for i, e in rows]
    assert found(spark, rows, recall=1.0) == brute(rows)


def test_one_component_and_single_row(spark):
    rows = [(i, [float(i - 30)]) for i in range(61)]
    assert found(spark, rows, recall=1.0) == brute(rows)
    assert found(spark, [(0, [1.0, 2.0])]) == []


def test_empty(spark):
    out = N.nearest(frame(spark, []))
    assert out.collect() == [] and out.columns == ["query_id", "rank", "vec_id", "score"]


def test_heap_goes_through_all_pairs_by_distance():
    rng = np.random.default_rng(2)
    index = N.Index(rng.normal(size=(300, 6)), 300)
    first, second = index.distances(rng.normal(size=(1, 6)))
    taken = list(index.traverse(first[0], second[0]))
    sums = (first[0][:, None] + second[0][None, :]).ravel()
    assert sorted(c for _, c in taken) == list(range(len(sums)))
    assert np.allclose([d for d, _ in taken], np.sort(sums)) and all(np.isclose(d, sums[c]) for d, c in taken)


def test_parts_hold_hot_cells():
    counts = np.array([5, 0, 1000, 3, 90, 0])
    parts = N.Parts(counts, 100)
    cells = np.repeat(np.arange(6), counts)
    part = parts.of_entries(cells, np.arange(len(cells)))
    assert np.bincount(part).max() <= 300 and part.max() < parts.number
    for c in np.flatnonzero(counts):
        assert set(part[cells == c]) <= set(parts.of_cells([c]))


@pytest.mark.parametrize("clustered", [False, True])
def test_recall(spark, clustered):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 16))
    x = centres[rng.integers(0, 60, 2000)] + rng.normal(0, 0.2, (2000, 16)) if clustered else rng.normal(size=(2000, 16))
    rows = [(i, e) for i, e in enumerate(x.tolist())]
    search = N.Search(frame(spark, rows))
    budget = search.fit_budget()
    got = search.neighbours(budget).collect()
    true = brute(rows)
    assert len(got) == len(true) == 2000
    score = {(r[0], r[2]): r[3] for r in true}
    hits = [(r["query_id"], r["vec_id"]) for r in got if (r["query_id"], r["vec_id"]) in score]
    assert len(hits) / len(true) >= 0.94
    assert all(score[k] == r["score"] for r in got for k in [(r["query_id"], r["vec_id"])] if k in score)
    if clustered:
        assert budget < 600  # structure makes the search short


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    true = {(r[0], r[2]) for r in brute(rows)}
    got = N.nearest(table).collect()
    assert len(got) == 20 * 25 and sum((r["query_id"], r["vec_id"]) in true for r in got) >= 0.9 * len(true)
