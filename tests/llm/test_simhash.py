import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from aerolake.llm import simhash
from aerolake.llm.components import connected_components, join_keys


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, max_bits=4):
    """least node of each fingerprint's component, by search over all pairs."""
    nodes, out = sorted(nodes), {}
    for n in nodes:
        if n in out:
            continue
        reach, todo = {n}, [n]
        while todo:
            x = todo.pop()
            near = {y for y in nodes if y not in reach and (x ^ y).bit_count() <= max_bits}
            reach |= near
            todo += near
        out |= dict.fromkeys(reach, n)
    return out


@pytest.mark.parametrize("max_bits", [0, 1, 3, 4, 7])
def test_ring_links_span_all_links(max_bits):
    rng = np.random.default_rng(max_bits)
    fps = [int(x) for x in rng.integers(0, 2**63, 60, dtype=np.uint64)]
    for centre in fps[:6]:
        for _ in range(40):
            flips = rng.choice(64, int(rng.integers(0, 6)), replace=False)
            fps.append(centre ^ sum(1 << int(b) for b in flips))
    fps = np.unique(np.array(fps, np.uint64))
    a, b = simhash.ring_links(fps, max_bits, block=500)
    assert (np.bitwise_count(fps[a] ^ fps[b]) > 0).all()
    parent = {int(x): int(x) for x in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(fps[a], fps[b]):
        x, y = sorted((root(int(x)), root(int(y))))
        parent[y] = x
    want = brute_components([int(x) for x in fps], max_bits)
    groups = lambda f: sorted(sorted(int(x) for x in fps if f(int(x)) == g) for g in {f(int(x)) for x in fps})
    assert groups(root) == groups(want.get)


def brute(rows):
    fps = [brute_fp(r["text"]) for r in rows]
    comp = brute_components(set(fps))
    least = {}
    for r, f in zip(rows, fps):
        if r["doc_id"] is not None:
            least[comp[f]] = min(least.get(comp[f], r["doc_id"]), r["doc_id"])
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0, f"{f:016x}", least.get(comp[f])) for r, f in zip(rows, fps)), key=str)


@pytest.mark.parametrize("which", ["small_docs", "awkward", "no_docs"])
def test_near_duplicates(which, request):
    docs = request.getfixturevalue(which)
    got = [(r["doc_id"] is not None, r["doc_id"] or 0, f"{r['fp'] & 0xffffffffffffffff:016x}", r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == brute(docs.collect())


def test_long_texts_are_summed_in_blocks():
    texts = [" ".join(f"w{i * 7 % 311}" for i in range(n)) for n in (0, 1, 3, 5, 40, 1000)]
    got = simhash.fingerprint_of([t.encode() for t in texts], block=16)
    assert [int(x) for x in got] == [brute_fp(t) for t in texts]


def test_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(base[:i % 390] + [f"v{i}"] + base[i % 390 + 1:])) for i in range(700)] + [(1000 + i, "same words here") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert [(r[1], r[3]) for r in sorted(brute(docs.collect()), key=lambda r: r[1])] == got
    assert simhash.links(simhash.fingerprints(docs).select("fp").distinct()).count() < 5 * 700


def test_keep_one(awkward):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 5, 6, 7, None], key=str)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 300), (7, 7), (300, 100)], "a long, b long")
    got = dict(connected_components(edges).collect())
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100}


def test_keep_one_with_repeated_and_missing_ids(spark):
    a, b, c = ("one two three four five six seven", "quite another text with other words in it", "a third one that nobody else has got here")
    rows = [(1, a), (1, b), (2, b), (None, a), (None, c), (None, c.upper()), (None, "  " + c)]
    kept = [tuple(r) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(kept) == 3 and {(1, a), (1, b)} <= set(kept)
    assert [t.lower().strip() for i, t in kept if i is None] == [c]


def groups(edges):
    """The sets of nodes that edges connect."""
    own = {}
    for a, b in edges:
        both = own.get(a, {a}) | own.get(b, {b})
        own.update(dict.fromkeys(both, both))
    return {frozenset(x) for x in own.values()}


@pytest.mark.parametrize("max_bits", [3, 4, 6])
def test_hot_buckets_are_dealt_over_tasks(spark, max_bits):
    """A third of the fingerprints share most of their bits; no cell holds more than a task may."""
    rng, per_task = np.random.default_rng(7), 60
    near = 0x123456789ABCDEF0 ^ np.bitwise_or.reduce(np.left_shift(np.uint64(1), rng.integers(0, 64, (500, 3), np.uint64)), axis=1)
    fps = np.unique(np.concatenate([near, rng.integers(0, 1 << 63, 1000, np.uint64)]))
    rows = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(3)
    got = groups((r["a"], r["b"]) for r in simhash.links(rows, max_bits, per_task).collect())
    a, b = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits, 1))
    assert got == groups(zip(fps.view(np.int64)[a].tolist(), fps.view(np.int64)[b].tolist())) and got

    segments = simhash._segments(max_bits)
    buckets = rows.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), F.shiftrightunsigned("fp", a).bitwiseAND((1 << w) - 1).alias("val"))
                                                    for i, (a, w) in enumerate(segments)])).alias("s")).select("s.seg", "s.val", "fp")
    heavy = buckets.groupBy("seg", "val").count().where(F.col("count") > per_task).select("seg", "val")
    assert heavy.count()
    cells, total = simhash._cells(buckets, heavy, segments, max_bits, per_task)
    sizes = [r["count"] for r in cells.groupBy("seg", "val", "cell", "a", "b").count().collect()]
    assert sum(sizes) == total and max(sizes) <= 1.5 * per_task


def test_join_keys(spark):
    rows = spark.createDataFrame([(0, i) for i in range(3000)] + [(1 + i % 2500, i) for i in range(5000)] + [(9999, 1)], "k long, v long")
    keys = rows.where("k <> 9999").groupBy("k").agg(F.count("*").alias("n"), (F.min("k") * 2).alias("w"))
    got = join_keys(rows, keys, "k", rows.count())
    assert got.columns == ["k", "v", "w"] and got.count() == 8000 and got.where("w <> 2 * k").count() == 0
