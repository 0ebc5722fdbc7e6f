"""Centroid clustering (Lloyd's rounds in exact integers) with geometric drift tightening.

Every vector carries an upper bound of the distance to its own centroid and a lower bound
of the distance to any other. When centroids move, the upper bound grows by the own
centroid's drift. The lower bound need not give up the largest drift: all members of a
cluster lie in the sphere around its old centroid c with the cluster's radius r. In the
plane through c, another centroid's old place f and its new place g, let D = |c - f|,
d = |g - f| and alpha the angle at f between c and g. For a point x at distance s from f
under the angle phi, the law of cosines gives |x - g| >= s - d cos(phi). Seen from f, the
sphere takes up the angles alpha -+ asin(r / D), so no member comes nearer to the moved
centroid by more than d cos(max(0, alpha - asin(r / D))) (d if f lies in the sphere). The
lower bound gives up the largest of these values; a centroid that moves away adds to it.

A vector whose upper bound stays clearly below its lower bound, or below half the distance
from its centroid to the next one, keeps its cluster; the ambiguous ones get their exact
distance, and if that does not settle it, a scan of all centroids. So results are those
of plain Lloyd's rounds. Each round is one map over the vectors, written with its bounds
to the shared folder; every task adds a row of sums for each cluster to what it writes.
Only those sums (clusters x components) reach the driver.

Defined cases: vectors that are null, of another length, or hold a null or non-finite
component take no part; repeated rows count each; a null vec_id is kept (such rows are the
last choice for a starting centroid); with fewer vectors than clusters each one is a
starting centroid; an empty table gives an empty result. Components beyond 2^22 are
counted with Python integers; a distance or sum that a long can't hold is null, and sums
of 10^38 or more raise an error.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CLUSTERS = 16
ROUNDS = 3
DIMENSIONS = 64
SCALE = 64
#: Up to this size, squares and their sums over a vector are exact in doubles.
EXACT = 1 << 22
#: Bounds are told apart only beyond this share of their size (rounding of square roots).
MARGIN = 1e-9
LONG_MAX = (1 << 63) - 1

STATE = ("vec_id long, vec array<double>, cluster int, upper double, lower double, distance long, "
         "members long, sums array<decimal(38,0)>, radius double, scanned long, inertia decimal(38,0)")


def squared_distances(vectors: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Exact squared distance of every (integer-valued) vector to every centroid: doubles
    where these are exact, else Python integers."""
    largest = max((abs(x) for c in centroids for x in c), default=0)
    if largest < EXACT and (not vectors.size or np.abs(vectors).max() < EXACT):
        c = np.array(centroids, np.float64).reshape(len(centroids), -1)
        return (vectors * vectors).sum(1)[:, None] - 2 * (vectors @ c.T) + (c * c).sum(1)
    v = np.array([[int(x) for x in row] for row in vectors], object)
    return np.array([[sum((x - y) ** 2 for x, y in zip(row, c)) for c in centroids] for row in v], object).reshape(len(vectors), -1)


def _between(a: list[int], b: list[int]) -> float:
    return math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))


def loosening(old: list[list[int]], new: list[list[int]], radius: list[float], tighten: bool = True) -> list[float]:
    """By how much each cluster's lower bounds must give way: the most that any member can
    come nearer to another cluster's moved centroid (``tighten=False``: that one's full drift)."""
    out = []
    for i, c in enumerate(old):
        most = -math.inf
        for j, (f, g) in enumerate(zip(old, new)):
            if j == i:
                continue
            drift, far = _between(f, g), _between(c, f)
            nearer = drift
            if tighten and drift > 0 and far > radius[i]:
                cosine = sum((x - y) * (z - y) for x, y, z in zip(c, f, g)) / (far * drift)
                angle = math.acos(max(-1.0, min(1.0, cosine))) - math.asin(radius[i] / far)
                nearer = drift * math.cos(max(0.0, angle))
            most = max(most, nearer)
        out.append(most)
    return out


def _half_gaps(centroids: list[list[int]]) -> list[float]:
    return [min((_between(c, o) for j, o in enumerate(centroids) if j != i), default=math.inf) / 2 for i, c in enumerate(centroids)]


class Round:
    """What a task needs to assign vectors: centroids, and how bounds change with their last move."""

    def __init__(self, centroids, old=None, radius=None, last=False, tighten=True):
        self.centroids, self.last = centroids, last
        self.drift = None if old is None else np.array([_between(a, b) for a, b in zip(old, centroids)])
        self.loosen = None if old is None else np.array(loosening(old, centroids, radius, tighten))
        self.half = np.array(_half_gaps(centroids))

    def assign(self, vectors, cluster, upper, lower):
        """(cluster, upper, lower, exact squared distance to the own centroid or None, vectors scanned)."""
        n = len(vectors)
        if self.drift is None:
            doubt = np.arange(n)
            cluster, upper, lower = np.zeros(n, np.int32), np.zeros(n), np.zeros(n)
        else:
            upper = (upper + self.drift[cluster]) * (1 + MARGIN)
            lower = lower - self.loosen[cluster]
            doubt = self._doubt(np.arange(n), cluster, upper, lower)
            if len(doubt):
                upper[doubt] = np.sqrt(self._own(vectors[doubt], cluster[doubt]).astype(np.float64))
                doubt = self._doubt(doubt, cluster, upper, lower)
        if len(doubt):
            d = squared_distances(vectors[doubt], self.centroids)
            best = d.argmin(1).astype(np.int32)  # of equal ones the smallest number
            rows = np.arange(len(doubt))
            cluster[doubt], upper[doubt] = best, np.sqrt(d[rows, best].astype(np.float64))
            rest = d.astype(np.float64)
            rest[rows, best] = np.inf
            lower[doubt] = np.sqrt(rest.min(1))
        return cluster, upper, lower, self._own(vectors, cluster) if self.last else None, len(doubt)

    def _doubt(self, rows, cluster, upper, lower):
        bound = np.maximum(lower[rows], self.half[cluster[rows]])
        return rows[~(upper[rows] + MARGIN * (1 + upper[rows]) < bound)]

    def _own(self, vectors, cluster):
        """Squared distance to the own centroid alone, members of each cluster together."""
        out = np.zeros(len(vectors), object if np.abs(vectors).max(initial=0) >= EXACT or any(abs(x) >= EXACT for c in self.centroids for x in c) else np.float64)
        for j in np.unique(cluster):
            at = np.flatnonzero(cluster == j)
            out[at] = squared_distances(vectors[at], [self.centroids[j]])[:, 0]
        return out


def _long(x) -> int | None:
    return int(x) if abs(int(x)) <= LONG_MAX else None


class _Sums:
    """Sums of a task's vectors by cluster, in integers that can't overflow."""

    def __init__(self):
        self.rows = {}

    def add(self, vectors, cluster, upper, own):
        for j in np.unique(cluster).tolist():
            at = np.flatnonzero(cluster == j)
            v = vectors[at]
            small = np.abs(v).max(initial=0) < EXACT
            sums = v.astype(np.int64).sum(0).tolist() if small else [sum(int(x) for x in col) for col in v.T]
            n, old, radius, inertia = self.rows.get(j, (0, [0] * v.shape[1], 0.0, 0))
            self.rows[j] = (n + len(at), [a + b for a, b in zip(old, sums)], max(radius, float(upper[at].max())),
                            inertia + (sum(map(int, own[at])) if own is not None else 0))


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _batch(**columns) -> pa.RecordBatch:
    types = {"vec_id": pa.int64(), "vec": pa.list_(pa.float64()), "cluster": pa.int32(), "upper": pa.float64(), "lower": pa.float64(),
             "distance": pa.int64(), "members": pa.int64(), "sums": pa.list_(pa.decimal128(38, 0)), "radius": pa.float64(),
             "scanned": pa.int64(), "inertia": pa.decimal128(38, 0)}
    rows = len(columns["cluster"])
    arrays = [pa.array(columns[name], kind) if name in columns and not isinstance(columns[name], pa.Array)
              else columns[name] if name in columns else pa.nulls(rows, kind) for name, kind in types.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(types))


def _task(step: Round, dims: int, first: bool):
    """A map over batches of vectors (``first``: as doubles still to be scaled) or of the state before."""

    def run(batches):
        sums, scanned = _Sums(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                vectors = _vectors(common.column(part, "vec"), dims)
                if first:
                    vectors = np.floor(vectors * SCALE)
                    bounds = (None, None, None)
                else:
                    bounds = tuple(common.column(part, c).to_numpy().copy() for c in ("cluster", "upper", "lower"))
                cluster, upper, lower, own, n = step.assign(vectors, *bounds)
                scanned += n
                sums.add(vectors, cluster, upper, own)
                offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * dims)
                vec = pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel()))
                extra = {} if own is None else {"distance": [_long(x) for x in own]}
                yield _batch(vec_id=common.column(part, "vec_id"), vec=vec, cluster=cluster, upper=upper, lower=lower, **extra)
        if sums.rows:
            keys = list(sums.rows)
            n, totals, radius, inertia = zip(*(sums.rows[j] for j in keys))
            yield _batch(cluster=keys, members=n, sums=[[_decimal(x) for x in t] for t in totals], radius=radius,
                         scanned=[scanned] + [0] * (len(keys) - 1), inertia=[_decimal(x) for x in inertia])

    return run


def _decimal(x: int):
    import decimal

    return decimal.Decimal(x)


def _summary(state: DataFrame, k: int, dims: int):
    """Members, sums, radius and inertia of each cluster, and vectors scanned, of all tasks together."""
    rows = state.filter("members IS NOT NULL")
    totals = rows.groupBy("cluster").agg(F.sum("members").alias("members"), F.max("radius").alias("radius"),
                                         F.sum("inertia").alias("inertia"), F.sum("scanned").alias("scanned")).collect()
    parts = rows.select("cluster", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at").agg(F.sum("x").alias("x")).collect()
    members, radius, inertia, sums = [0] * k, [0.0] * k, [0] * k, [[0] * dims for _ in range(k)]
    for r in totals:
        members[r["cluster"]], radius[r["cluster"]], inertia[r["cluster"]] = r["members"], r["radius"], int(r["inertia"])
    for r in parts:
        sums[r["cluster"]][r["at"]] = int(r["x"])
    return members, sums, radius, inertia, sum(r["scanned"] for r in totals)


def kept_vectors(table: DataFrame, dims: int = DIMENSIONS) -> DataFrame:
    """vec_id, vec of the rows that take part."""
    common.find_library(table.sparkSession)
    vec = F.col("embedding").cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).filter((F.size("vec") == dims) & ~bad)


def starting_centroids(vectors: DataFrame, k: int) -> list[list[int]]:
    """The k vectors whose id has the smallest hash."""
    text = F.concat(F.lit("1:"), F.col("vec_id").cast("string"))
    rows = vectors.orderBy(F.sha2(text, 256).asc_nulls_last(), "vec").limit(k).collect()
    return [[int(math.floor(x * SCALE)) for x in r["vec"]] for r in rows]


def cluster_vectors(table: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMENSIONS,
                    tighten: bool = True) -> tuple[DataFrame, list[list[int]], list[int], list[int]]:
    """(vec_id, cluster, distance of every vector; the centroids; inertia of each cluster;
    vectors that each round had to scan over all centroids)."""
    vectors = kept_vectors(table, dims)
    centroids = starting_centroids(vectors, k)
    spark = table.sparkSession
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), [], [], []
    state, old, radius, scans = vectors, None, None, []
    for i in range(rounds + 1):
        step = Round(centroids, old, radius, last=i == rounds, tighten=tighten)
        state = common.staged((state if i == 0 else state.filter("vec IS NOT NULL").select("vec_id", "vec", "cluster", "upper", "lower"))
                              .mapInArrow(_task(step, dims, first=i == 0), STATE), "clusters")
        members, sums, radius, inertia, scanned = _summary(state, len(centroids), dims)
        scans.append(scanned)
        if i < rounds:
            old = centroids
            centroids = [[s // n for s in total] if n else c for c, n, total in zip(centroids, members, sums)]
    return state.filter("vec IS NOT NULL").select("vec_id", "cluster", "distance"), centroids, inertia, scans


def clusters(table: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMENSIONS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector."""
    found, centroids, inertia, _ = cluster_vectors(table, k, rounds, dims)
    rows = [(j, _long(x), _long(sum(inertia)), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for j, (c, x) in enumerate(zip(centroids, inertia))]  # a row for each of the k clusters
    facts = table.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(rounds: int = ROUNDS) -> str:
    """The same rows in DuckDB SQL, every round over all vectors and centroids."""
    parts = ["""kept AS (SELECT row_number() OVER () AS rn, vec_id,
        list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
parts AS (SELECT rn, unnest(range(1, 65)) AS pos, unnest(v) AS x FROM kept),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS j, v
    FROM kept QUALIFY j < 16)"""]
    for i in range(rounds + 1):
        parts.append(f"""d{i} AS (SELECT rn, j, list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS BIGINT))) AS d
    FROM kept, c{i}),
a{i} AS (SELECT rn, j, CAST(d AS BIGINT) AS d FROM d{i} QUALIFY row_number() OVER (PARTITION BY rn ORDER BY d, j) = 1)""")
        if i < rounds:
            parts.append(f"""m{i} AS (SELECT j, pos, CAST(sum(x) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n FROM a{i} JOIN parts USING (rn) GROUP BY j, pos),
n{i} AS (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS v FROM m{i} GROUP BY j),
c{i + 1} AS (SELECT c{i}.j, coalesce(n{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN n{i} USING (j))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(a{rounds}.j AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a{rounds}.j) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (rn) JOIN c{rounds} ON a{rounds}.j = c{rounds}.j"""


SQL = _sql()
