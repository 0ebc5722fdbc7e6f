"""SimHash near-duplicates, candidates pruned by the pigeonring principle.

Fingerprint: ASCII lower case, words between ASCII white space, word shingles, one
XXH64 (seed 42) each; a bit is 1 if it is set in over half of the hashes.

Links: if two fingerprints differ in at most t bits and are cut into m = t + 1 segments
on a ring, then from some segment i on every chain of l consecutive segments differs in
at most l * t / m bits. So segment i is equal, segments i and i + 1 differ in at most
one bit, and so on. Fingerprints (each distinct one once) meet in the bucket of an equal
segment; a task finds there the few whose next segment has at most one bit changed by
binary search, checks the longer chains, and only then the full distance. It reports a
spanning forest of the links it finds, never all pairs of a group.

Defined cases: a null text or one without words has fingerprint zero and links like any
other; repeated rows share a fingerprint and so a component; a null doc_id has the
component of its fingerprint (null if no row with an id is reachable).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import connected_components, join_keys

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Candidate pairs that a task holds at a time, and fingerprints of a bucket task.
BLOCK = 1 << 20
PER_TASK = 400_000
#: Widest segment whose buckets are counted and broadcast, and most cells that are broadcast.
MAX_SEGMENT = 16
MAX_BROADCAST = 1 << 20


def _bits(hashes: list[int]) -> np.ndarray:
    return np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprint_of(texts: list[bytes], shingle: int = SHINGLE, block: int = 1 << 17) -> np.ndarray:
    """uint64 fingerprint of each text. Short texts are summed together; a text of more
    than ``block`` shingles by itself, a block at a time."""
    ones, n = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    hashes, where, counts = [], [], []
    for i, t in enumerate(texts):
        words = t.lower().split()
        if not words:
            continue
        n[i] = max(1, len(words) - shingle + 1)
        if n[i] <= block:
            hashes.extend([digest(b" ".join(words[k:k + shingle]), SEED) for k in range(n[i])])
            where.append(i)
            counts.append(n[i])
        else:
            for at in range(0, n[i], block):
                ones[i] += _bits([digest(b" ".join(words[k:k + shingle]), SEED) for k in range(at, min(at + block, n[i]))]).sum(0, dtype=np.int64)
    if where:
        ones[where] = np.add.reduceat(_bits(hashes), np.cumsum(counts) - counts, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8")[:, 0]


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text_hash: Column | None = None) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), and text_hash if one is given."""
    names = ["doc_id", "fp"] + ["text_hash"] * (text_hash is not None)

    def run(batches):
        for batch in batches:
            for part, texts in common.slices(batch, limit=2 << 20):
                own = {"fp": pa.array(fingerprint_of(texts, shingle).view(np.int64))}
                yield pa.RecordBatch.from_arrays([own[c] if c in own else common.column(part, c) for c in names], names=names)

    rows = common.id_text(docs)
    if text_hash is not None:
        rows = rows.withColumn("text_hash", text_hash)
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the ring's segments."""
    m = max_bits + 1
    edges = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


class _Forest:
    """Union-find over 0..n-1, whole arrays at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x):
        while True:
            up = self.parent[x]
            if np.array_equal(up, x):
                return x
            x = up

    def flatten(self):
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return
            self.parent = up

    def link(self, a, b):
        while len(a):
            a, b = self.roots(a), self.roots(b)
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
        self.flatten()


def ring_links(fps: np.ndarray, max_bits: int = MAX_BITS, starts=None, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the links among distinct uint64 fingerprints whose chain starts at
    one of the segments ``starts`` (all, if none are given)."""
    segments = _segments(max_bits)
    m = len(segments)
    forest = _Forest(len(fps))
    for i in range(m) if starts is None else starts:
        ring = [segments[(i + k) % m] for k in range(m)]
        cut = [(fps >> np.uint64(a)) & np.uint64((1 << w) - 1) for a, w in ring]
        if m == 1:
            order = np.argsort(fps, kind="stable")
            same = np.flatnonzero(fps[order][1:] == fps[order][:-1])
            forest.link(order[same], order[same + 1])
            continue
        next_width = ring[1][1]
        key = (cut[0] << np.uint64(next_width)) | cut[1]
        order = np.argsort(key, kind="stable")
        key, at = key[order], fps[order]
        flips = [0] + ([1 << b for b in range(next_width)] if 2 * max_bits // m >= 1 else [])
        for flip in flips:
            probe = key ^ np.uint64(flip)
            low, high = np.searchsorted(key, probe, "left"), np.searchsorted(key, probe, "right")
            low = np.maximum(low, np.arange(len(key)) + 1)  # each pair once
            counts = np.maximum(high - low, 0)
            some = np.flatnonzero(counts)
            while len(some):
                total = np.cumsum(counts[some])
                n = max(1, int(np.searchsorted(total, block, "right")))
                now, some = some[:n], some[n:]
                for shift in range(0, int(counts[now].max()), block):  # one key's pairs may exceed a block
                    take = np.clip(counts[now] - shift, 0, block)
                    x = np.repeat(now, take)
                    y = np.repeat(low[now] + shift - (np.cumsum(take) - take), take) + np.arange(int(take.sum()))
                    for length in range(3, m + 1):
                        budget = length * max_bits // m
                        chain = np.uint64(0)
                        for a, w in ring[:length]:
                            chain |= np.uint64(((1 << w) - 1) << a)
                        near = np.bitwise_count((at[x] ^ at[y]) & chain) <= budget
                        x, y = x[near], y[near]
                    near = np.bitwise_count(at[x] ^ at[y]) <= max_bits
                    forest.link(order[x[near]], order[y[near]])
    child = np.flatnonzero(forest.parent != np.arange(len(fps)))
    return child, forest.parent[child]


def _cells(rows: DataFrame, heavy: DataFrame, segments: list[tuple[int, int]], max_bits: int, per_task: int) -> tuple[DataFrame, int]:
    """The rows (seg, val, fp) of buckets that one task can't hold, dealt into cells
    (seg, val, cell, a, b), and the number of rows that this makes.

    A chain of two segments differs in at most ``2 * max_bits // m`` bits, one for every
    budget below the number of segments, so a pair of the bucket has next segments that are
    equal or differ in one bit. Each row stands in the cell of its next segment and, for each
    bit set there, in the cell without that bit: every such pair meets in one cell. A cell
    that is still too large is cut into blocks, and each pair of blocks is dealt by itself.
    """
    m = len(segments)
    ring = F.lit(None).cast("long")
    for i in range(m):
        at, width = segments[(i + 1) % m]
        ring = F.when(F.col("seg") == i, F.shiftrightunsigned("fp", at).bitwiseAND((1 << width) - 1)).otherwise(ring)
    flips = F.array(F.lit(0), *[F.lit(1 << k) for k in range(max(w for _, w in segments))]) if 2 * max_bits // m >= 1 else F.array(F.lit(0))
    own = rows.join(F.broadcast(heavy), ["seg", "val"], "left_semi").withColumn("next", ring)
    own = own.withColumn("flip", F.explode(flips)).where((F.col("flip") == 0) | (F.col("next").bitwiseAND(F.col("flip")) != 0))
    own = own.select("seg", "val", F.col("next").bitwiseXOR(F.col("flip")).alias("cell"), "fp")
    block = max(1, per_task // 2)
    sizes = own.groupBy("seg", "val", "cell").count().withColumn(
        "blocks", F.when(F.col("count") > per_task, F.ceil(F.col("count") / block)).otherwise(1).cast("long"))
    few = common.staged(sizes.where("blocks > 1").select("seg", "val", "cell", "blocks"), "cells")
    n_few, total = few.count(), sizes.agg(F.sum(F.col("count") * F.col("blocks"))).first()[0]
    if n_few:
        # A cell above the size holds per_task rows: there are few, but not provably.
        own = own.join(F.broadcast(few) if n_few <= MAX_BROADCAST else few, ["seg", "val", "cell"], "left")
    else:
        own = own.withColumn("blocks", F.lit(None).cast("long"))
    mine = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1)))
    own = own.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)))
    return own.select("seg", "val", "cell", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "fp"), total or 0


def links(fps: DataFrame, max_bits: int = MAX_BITS, per_task: int = PER_TASK) -> DataFrame:
    """Edges (a, b) that span the near fingerprints among the distinct values of fps(fp).

    Every fingerprint goes to one bucket for each segment; buckets are dealt over tasks
    by their value. Which pairs meet depends on the segment's value alone, or, in buckets
    of more than ``per_task`` fingerprints, on the next segment's too (``_cells``), so no task
    grows with a bucket. There are at most as many buckets as values of all segments (some
    37,000 for 4 bits): their sizes are broadcast.
    """
    spark = fps.sparkSession
    common.find_library(spark)
    segments = _segments(max_bits)
    rows = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("seg"), F.shiftrightunsigned("fp", a).bitwiseAND((1 << w) - 1).alias("val"))
        for i, (a, w) in enumerate(segments)])).alias("s")).select("s.seg", "s.val", "fp")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = max(w for _, w in segments) <= MAX_SEGMENT and len(segments) > 1
    count = fps.count()
    heavy = None
    if narrow and count > per_task:  # no bucket holds more than all fingerprints
        heavy = common.staged(rows.groupBy("seg", "val").count().where(F.col("count") > per_task).select("seg", "val"), "buckets")
        heavy = None if heavy.isEmpty() else heavy

    def run(batches):
        got = [(common.column(b, "seg").to_numpy(), common.column(b, "fp").to_numpy()) for b in batches]
        if not got:
            return
        seg, fp = (np.concatenate(x) for x in zip(*got))
        fp = fp.view(np.uint64)
        for i in np.unique(seg):
            own = np.unique(fp[seg == i])  # a fingerprint may stand in several cells of a task
            a, b = ring_links(own, max_bits, starts=[int(i)])
            yield pa.RecordBatch.from_arrays([pa.array(own[a].view(np.int64)), pa.array(own[b].view(np.int64))], names=["a", "b"])

    tasks = max(least, common.spread_by_size(fps, count * len(segments), per_task))
    if heavy is None:
        return rows.repartition(tasks, "seg", "val").mapInArrow(run, "a long, b long")
    light = rows.join(F.broadcast(heavy), ["seg", "val"], "left_anti").repartition(tasks, "seg", "val")
    cells, total = _cells(rows, heavy, segments, max_bits, per_task)
    cells = cells.repartition(max(least, common.spread_by_size(fps, total, per_task)), "seg", "val", "cell", "a", "b")
    return light.select("seg", "fp").mapInArrow(run, "a long, b long").unionByName(cells.select("seg", "fp").mapInArrow(run, "a long, b long"))


def _components(marked: DataFrame, max_bits: int) -> DataFrame:
    """fp, first_id (the least doc_id with it) and component (its least fingerprint) of marked(doc_id, fp)."""
    ids = common.staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_docs")), "ids")
    parts = common.staged(connected_components(links(ids.select("fp"), max_bits)), "components")
    return common.staged(ids.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp")), "grouped")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id of every row of docs."""
    marked = common.staged(fingerprints(docs, shingle), "fingerprints")
    # The least document id of each component, then of each fingerprint.
    grouped = _components(marked, max_bits)
    least = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n"))
    by_fp = join_keys(grouped.select("fp", "component", "n_docs"), least, "component", grouped.count())
    by_fp = common.staged(by_fp.select("fp", "component_id", F.col("n_docs").alias("n")), "by_fp")
    return join_keys(marked, by_fp, "fp", marked.count()).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of docs with one document of each component: the one with the least id
    (a row without an id only if none has one), and of rows with that id the one whose
    text has the least hash. Rows of one id in two components each count in their own."""
    text = F.xxhash64(F.col("text").cast("string"))
    marked = common.staged(fingerprints(docs, shingle, text), "fingerprints")
    least = marked.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("row"))
    grouped = _components(marked, max_bits).select("fp", "component").join(least, "fp")
    first = grouped.groupBy("component").agg(F.min("row").alias("row")).select(F.col("row.doc_id").alias("_first"), F.col("row.text_hash").alias("_hash"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_first")) & (text == F.col("_hash"))
    return docs.join(first, same, "left_semi").dropDuplicates(["doc_id", "text"])
