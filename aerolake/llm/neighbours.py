"""Approximate nearest neighbours by largest inner product, through an inverted multi-index.

Index: vectors are cut into two halves, each quantised by its own k centroids; a vector
lies in the cell of its centroid pair. Codebooks are fitted by Lloyd's rounds on at most
``SAMPLE`` distinct vectors (those of the least hash); every vector is indexed. k grows
with the fourth root of the number n of distinct vectors, so a cell holds some sqrt(n) / 16.

Search: a query's distance to a pair is what its halves' inner products with the two
centroids lack to the best ones. A heap goes through the pairs by summed distance and stops
when the pairs that it has taken hold ``budget`` vectors; all entries of these pairs are
reranked by the exact inner product. The budget is no fixed number: for at most ``PILOTS``
queries (those of the least hash) the true neighbours are computed over all vectors, and
the budget is the least one that reaches ``RECALL`` of them. Data without structure get a
large budget, well clustered ones a small one, and recall holds at every size.

On Spark: the index is dealt into parts of bounded size by cell (a hot cell over several
parts). A query goes to the parts that hold one of its pairs; a task holds one part's
vectors and lets the queries pass in blocks. Equal vectors are one entry with their
``top + 1`` least ids, as no more of them can be found; equal queries are searched once.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component
take no part, nor does a null id as a query (as a candidate it sorts last); rows that share
an id are rows of their own, each excluded from its own result alone; a shorter vector
counts as filled up with zeros; ties go to the smaller id; an empty table gives an empty
result. A score is the sum of the products from the first component to the last, in doubles.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

TOP = 20
#: Queries are the rows whose id is divisible by this.
QUERY_STEP = 20
SAMPLE = 20_000
PILOTS = 256
RECALL = 0.97
#: Vectors of a part of the index: at least (if n allows), and at most, on average.
PART_MIN, PART_MAX = 2_048, 32_768
#: Queries that are compared with a part at a time.
QUERY_BLOCK = 256
#: Rounding of an inner product, as a share of the product of lengths.
SLACK = 1e-9


def half_width(dims: int) -> int:
    return dims // 2


def centroids_for(n: int) -> int:
    """Centroids of each half for n vectors: a power of two from 4 to 1024."""
    return 1 << int(np.clip(np.rint(np.log2(max(n, 1)) / 4 + 2), 2, 10))


def fit_codebook(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """k centroids (or as many as there are distinct rows) of the sample's half vectors."""
    distinct = np.unique(x, axis=0)
    c = distinct[np.random.default_rng(0).permutation(len(distinct))[:k]]
    for _ in range(rounds):
        nearest = quantise(x, c)
        n = np.bincount(nearest, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, nearest, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def quantise(x: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    return ((codebook * codebook).sum(1) - 2 * (x @ codebook.T)).argmin(1)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component on."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


class Index:
    """Codebooks and number of vectors by cell: all that a search must know to choose cells."""

    def __init__(self, sample: np.ndarray, n: int):
        self.dims = sample.shape[1]
        self.cut = half_width(self.dims)
        k = centroids_for(n)
        self.books = fit_codebook(sample[:, :self.cut], k), fit_codebook(sample[:, self.cut:], k)
        self.shape = len(self.books[0]), len(self.books[1])
        self.counts = np.zeros(self.shape[0] * self.shape[1], np.int64)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        return quantise(vectors[:, :self.cut], self.books[0]) * self.shape[1] + quantise(vectors[:, self.cut:], self.books[1])

    def distances(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each half's products with the centroids lack to the best one."""
        first, second = queries[:, :self.cut] @ self.books[0].T, queries[:, self.cut:] @ self.books[1].T
        return first.max(1, keepdims=True) - first, second.max(1, keepdims=True) - second

    def traverse(self, first: np.ndarray, second: np.ndarray):
        """Pairs of one query by summed distance: yields (distance, cell). A pair enters the
        heap when its neighbours before it, in both halves' orders, have been taken."""
        i_order, j_order = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
        a, b = first[i_order].tolist(), second[j_order].tolist()
        heap, reached, width = [(a[0] + b[0], 0, 0)], [0] * len(a), self.shape[1]  # reached[i]: pairs of i taken
        while heap:
            d, i, j = heapq.heappop(heap)
            yield d, i_order[i] * width + j_order[j]
            reached[i] = j + 1
            if i + 1 < len(a) and reached[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
            if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))

    def reach(self, first: np.ndarray, second: np.ndarray, budget: int) -> tuple[float, list[int]]:
        """(distance of the last pair taken, the non-empty cells taken) until they hold ``budget`` vectors."""
        counts, held, cells, last = self.counts, 0, [], 0.0
        for last, cell in self.traverse(first, second):
            if n := int(counts[cell]):
                cells.append(cell)
                held += n
                if held >= budget:
                    break
        return last, cells

    def before(self, first: np.ndarray, second: np.ndarray, wanted: list[int]) -> list[int]:
        """For each wanted cell, vectors in the pairs taken before it."""
        missing, held, found = set(wanted), 0, {}
        for _, cell in self.traverse(first, second):
            if cell in missing:
                found[cell] = held
                missing.discard(cell)
                if not missing:
                    break
            held += int(self.counts[cell])
        return [found[c] for c in wanted]


class Parts:
    """Which parts of the index hold which cell. Cells follow each other; one with more
    vectors than a part is dealt over several."""

    def __init__(self, counts: np.ndarray, size: int):
        ends = np.cumsum(counts)
        self.first = (ends - counts) // size
        self.spread = np.maximum(-(-counts // size), 1)
        self.number = int(ends[-1] // size) + int(self.spread.max(initial=1)) if len(counts) else 1

    def of_entries(self, cells: np.ndarray, salt: np.ndarray) -> np.ndarray:
        return self.first[cells] + salt % self.spread[cells]

    def of_cells(self, cells) -> list[int]:
        cells = np.array(cells, np.int64)
        first, n = self.first[cells], self.spread[cells]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return np.unique(np.repeat(first, n) + at).tolist()


def valid_rows(table: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id, vec of the rows that take part."""
    common.find_library(table.sparkSession)
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    return rows.filter(F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0)).withColumn("row", F.monotonically_increasing_id())


def matrix(column, dims: int) -> np.ndarray:
    """The vectors as rows of a matrix, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, lens = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (lens == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lens), dims))
    row = np.repeat(np.arange(len(lens)), lens)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    return out


def _best(scores: np.ndarray, slack: np.ndarray, top: int):
    """(row, column) of all scores that may be among a row's ``top`` greatest; -inf never is."""
    kth = -np.partition(-scores, top - 1, axis=1)[:, top - 1] if scores.shape[1] >= top else np.full(len(scores), -np.inf)
    return np.nonzero((scores >= (kth - slack)[:, None]) & (scores > -np.inf))


_IDS = pa.list_(pa.struct([("vec_id", pa.int64()), ("row", pa.int64())]))


def _ranked(q: np.ndarray, score: np.ndarray, ids: pa.Array, top: int) -> np.ndarray:
    """Positions of each query's ``top`` best by score, then least id."""
    least = ids.flatten().field("vec_id").take(pa.array(ids.offsets.to_numpy()[:-1])) if len(ids) else pa.array([], pa.int64())
    none = least.is_null().to_numpy(zero_copy_only=False)
    order = np.lexsort((least.fill_null(0).to_numpy(), none, -score, q))
    sorted_q = q[order]
    start = np.concatenate([[True], sorted_q[1:] != sorted_q[:-1]])[:len(order)]
    number = np.arange(len(order)) - np.maximum.accumulate(np.where(start, np.arange(len(order)), 0))
    return order[number < top]


def _scored(queries: np.ndarray, vectors: np.ndarray, seen: np.ndarray | None, ids: pa.Array, top: int):
    """(query, score, ids) of each query's best among the vectors that it may see."""
    scores = queries @ vectors.T
    if seen is not None:
        scores[~seen] = -np.inf
    slack = SLACK * np.sqrt((queries * queries).sum(1)) * np.sqrt((vectors * vectors).sum(1).max(initial=0))
    q, v = _best(scores, slack, top)
    score = exact_scores(queries[q], vectors[v])
    found = ids.take(pa.array(v))
    best = _ranked(q, score, found, top)
    return q[best], score[best], found.take(pa.array(best))


_FOUND = "q long, score double, ids array<struct<vec_id: long, row: long>>"


def _top_nodes(found: DataFrame, top: int) -> DataFrame:
    """Each query's best entries of all parts."""
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("ids")[0]["vec_id"].asc_nulls_last())
    return found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= top).drop("n")


class Search:
    """An index over a table and its search; the steps are kept as tables in the shared folder."""

    def __init__(self, table: DataFrame, top: int = TOP, step: int = QUERY_STEP, sample: int = SAMPLE):
        self.top, self.spark = top, table.sparkSession
        self.rows = common.staged(valid_rows(table), "ann_rows")
        # Equal vectors become one node, with the ids that any result can need.
        own = Window.partitionBy("vec", "salt").orderBy(F.col("vec_id").asc_nulls_last(), "row")
        every = Window.partitionBy("vec").orderBy(F.col("vec_id").asc_nulls_last(), "row")
        few = (self.rows.withColumn("salt", F.pmod("row", F.lit(64))).withColumn("n", F.row_number().over(own)).filter(F.col("n") <= top + 1)
               .withColumn("n", F.row_number().over(every)).filter(F.col("n") <= top + 1))
        nodes = few.groupBy("vec").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "row"))).alias("ids"))
        self.nodes = common.staged(nodes.select(F.col("ids")[0]["row"].alias("node"), "vec",
                                                F.transform("ids", lambda x: F.struct(x["vec_id"].alias("vec_id"), x["row"].alias("row"))).alias("ids")), "ann_nodes")
        queries = self.rows.filter(F.col("vec_id") % step == 0)
        self.queries = common.staged(queries.join(self.nodes.select("node", "vec"), "vec").select("vec_id", "row", "node"), "ann_queries")
        self.asked = common.staged(self.nodes.join(self.queries.select("node").distinct(), "node", "left_semi"), "ann_asked")
        self.n, self.dims = self.nodes.agg(F.count("*"), F.max(F.size("vec"))).first()
        self.index = None
        if self.n:
            drawn = self.nodes.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(sample).toArrow()
            self.index = Index(matrix(drawn.column("vec"), self.dims), self.n)
            self.entries = common.staged(self._entries(), "ann_entries")
            for r in self.entries.groupBy("cell").count().collect():  # k * k numbers at most
                self.index.counts[r["cell"]] = r["count"]

    def _entries(self) -> DataFrame:
        index, dims = self.index, self.dims

        def run(batches):
            for b in batches:
                cells = index.cells(matrix(common.column(b, "vec"), dims))
                yield pa.RecordBatch.from_arrays([common.column(b, "node"), pa.array(cells.astype(np.int64)), common.column(b, "vec"), common.column(b, "ids")],
                                                 names=["node", "cell", "vec", "ids"])

        return self.nodes.mapInArrow(run, "node long, cell long, vec array<double>, ids array<struct<vec_id: long, row: long>>")

    def true_neighbours(self, queries: DataFrame) -> DataFrame:
        """q, score, ids, cell of the best entries of a few queries (node, vec), by comparing all."""
        asked = queries.select("node", "vec").toArrow()
        q_ids, q_vec, dims, top = asked.column("node").to_numpy(), matrix(asked.column("vec"), self.dims), self.dims, self.top + 1

        def run(batches):
            q, score, ids, cell = np.zeros(0, np.int64), np.zeros(0), pa.array([], _IDS), np.zeros(0, np.int64)
            for b in batches:
                own, place = pa.concat_arrays([common.column(b, "ids").cast(_IDS)]), common.column(b, "cell").to_numpy()
                # each entry's cell travels along as its place in the batch
                vectors = matrix(common.column(b, "vec"), dims)
                scores = q_vec @ vectors.T
                slack = SLACK * np.sqrt((q_vec * q_vec).sum(1)) * np.sqrt((vectors * vectors).sum(1).max(initial=0))
                a, v = _best(scores, slack, top)
                q, score = np.concatenate([q, a]), np.concatenate([score, exact_scores(q_vec[a], vectors[v])])
                ids, cell = pa.concat_arrays([ids, own.take(pa.array(v))]), np.concatenate([cell, place[v]])
                best = _ranked(q, score, ids, top)
                q, score, ids, cell = q[best], score[best], ids.take(pa.array(best)), cell[best]
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[q]), pa.array(score), ids, pa.array(cell)], names=["q", "score", "ids", "cell"])

        return _top_nodes(self.entries.mapInArrow(run, _FOUND + ", cell long"), top)

    def fit_budget(self, recall: float = RECALL, pilots: int = PILOTS) -> int:
        """The least budget by which the pilots' true neighbours are found with the given recall."""
        chosen = self.asked.orderBy(F.xxhash64("node"), "node").limit(pilots).select("node", "vec")
        asked = chosen.toArrow()
        vectors = dict(zip(asked.column("node").to_pylist(), matrix(asked.column("vec"), self.dims)))
        wanted: dict = {}
        found = self.true_neighbours(chosen).filter(F.col("ids")[0]["row"] != F.col("q"))  # not the pilot itself
        for r in found.select("q", "cell").collect():  # top rows a pilot
            wanted.setdefault(r["q"], []).append(r["cell"])
        need = []
        for q, cells in wanted.items():
            first, second = self.index.distances(vectors[q][None])
            need += self.index.before(first[0], second[0], cells)
        need.sort()
        least = need[min(len(need) - 1, int(np.ceil(recall * len(need))))] + 1 if need else 1
        return max(least, self.top + 1)  # enough for a full list

    def found(self, budget: int) -> DataFrame:
        """q, score, ids: the best entries of every asked node among those that its pairs hold."""
        index, dims, top = self.index, self.dims, self.top + 1
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        size = int(np.clip(-(-self.n // tasks), PART_MIN, PART_MAX))
        parts = Parts(index.counts, size)

        def deal(batches):
            for b in batches:
                part = parts.of_entries(common.column(b, "cell").to_numpy(), common.column(b, "node").to_numpy())
                yield _stream(b, pa.array(part), common.column(b, "node"), common.column(b, "cell"), pa.nulls(b.num_rows, pa.float64()), common.column(b, "ids"))

        def ask(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    b = batch.slice(at, 256)
                    first, second = index.distances(matrix(common.column(b, "vec"), dims))
                    rows = [(i, p, d) for i, (x, y) in enumerate(zip(first, second))
                            for d, cells in [index.reach(x, y, budget)] for p in parts.of_cells(cells)]
                    at_row, part, reach = (np.array(c) for c in zip(*rows))
                    yield _stream(b.take(pa.array(at_row)), pa.array(part), common.column(b, "node").take(pa.array(at_row)),
                                  pa.nulls(len(rows), pa.int64()), pa.array(reach), pa.nulls(len(rows), _IDS))

        schema = "part long, node long, cell long, reach double, vec array<double>, ids array<struct<vec_id: long, row: long>>"
        stream = self.entries.mapInArrow(deal, schema).unionByName(self.asked.mapInArrow(ask, schema))

        def search(batches):
            part, entries, ready = None, [], None
            for batch in batches:
                numbers, is_entry = common.column(batch, "part").to_numpy(), common.column(batch, "reach").is_null().to_numpy(zero_copy_only=False)
                edges = np.flatnonzero((numbers[1:] != numbers[:-1]) | (is_entry[1:] != is_entry[:-1])) + 1
                for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(numbers)]):
                    if numbers[a] != part:
                        part, entries, ready = numbers[a], [], None
                    if is_entry[a]:
                        entries.append(batch.slice(a, b - a))
                        continue
                    if ready is None:
                        ready = _Part(entries, dims)
                    for at in range(a, b, QUERY_BLOCK):
                        block = batch.slice(at, min(QUERY_BLOCK, b - at))
                        yield from ready.search(index, block, top)

        tasks = max(tasks, parts.number)
        dealt = stream.repartition(tasks, "part").sortWithinPartitions("part", F.col("reach").asc_nulls_first())
        return _top_nodes(dealt.mapInArrow(search, _FOUND), top)

    def neighbours(self, budget: int) -> DataFrame:
        """query_id, rank, vec_id, score."""
        one = self.found(budget).select("q", F.explode(F.transform("ids", lambda x: F.struct(
            (-F.col("score")).alias("less"), x["vec_id"].isNull().alias("none"), x["vec_id"].alias("vec_id"), x["row"].alias("row"), F.col("score").alias("score")))).alias("x"))
        lists = one.groupBy("q").agg(F.slice(F.sort_array(F.collect_list("x")), 1, self.top + 1).alias("near"))  # (top + 1)^2 at most before the cut
        # a hot query vector's rows meet a copy of its list in each of several groups
        salts = 32
        asked = self.queries.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
        lists = lists.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        own = asked.join(lists, [asked["node"] == lists["q"], asked["salt"] == lists["salt"]]).select(
            F.col("vec_id").alias("query_id"), F.slice(F.filter("near", lambda x: x["row"] != F.col("row")), 1, self.top).alias("near"))
        return own.select("query_id", F.posexplode("near").alias("at", "x")).select(
            "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def _stream(batch, part, node, cell, reach, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([part, node, cell, reach, common.column(batch, "vec"), ids], names=["part", "node", "cell", "reach", "vec", "ids"])


class _Part:
    """One part of the index in a task."""

    def __init__(self, batches: list[pa.RecordBatch], dims: int):
        self.vectors = np.concatenate([matrix(common.column(b, "vec"), dims) for b in batches]) if batches else np.zeros((0, dims))
        self.ids = pa.concat_arrays([common.column(b, "ids").cast(_IDS) for b in batches]) if batches else pa.array([], _IDS)
        self.cells, self.cell = np.unique(np.concatenate([common.column(b, "cell").to_numpy() for b in batches]) if batches else np.zeros(0, np.int64),
                                          return_inverse=True)
        self.dims = dims

    def search(self, index: Index, block: pa.RecordBatch, top: int):
        queries = matrix(common.column(block, "vec"), self.dims)
        first, second = index.distances(queries)
        i, j = np.divmod(self.cells, index.shape[1])
        far = common.column(block, "reach").to_numpy()[:, None]
        seen = first[:, i] + second[:, j] <= far + SLACK * (1 + np.abs(far))
        some = seen.any(0)  # cells that a query of the block has taken
        at = np.flatnonzero(some[self.cell])
        q, score, ids = _scored(queries, self.vectors[at], seen[:, self.cell[at]], self.ids.take(pa.array(at)), top)
        yield pa.RecordBatch.from_arrays([common.column(block, "node").take(pa.array(q)), pa.array(score), ids], names=["q", "score", "ids"])


def nearest(table: DataFrame, top: int = TOP, step: int = QUERY_STEP, recall: float = RECALL, sample: int = SAMPLE, pilots: int = PILOTS) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row its ``top`` nearest found."""
    search = Search(table, top, step, sample)
    if search.index is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search.neighbours(search.fit_budget(recall, pilots))
