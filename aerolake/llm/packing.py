"""Best-fit packing of token sequences, certified by lower bounds.

Every document becomes its token ids and one end id; documents longer than the
sequence length are cut. Pieces are dealt into partitions and each partition is packed
best-fit decreasing. Dual-feasible functions give a lower bound of the bins each
partition needs: where the bound equals the bins used, the partition is certified and
rests. Partitions with a gap give up the pieces of their bins with free space, exchange
them by dealing them anew, and pack them again, until all are certified or several deals
in a row have saved no bin. Every piece tells the bins and the bound of the partition it
was packed in, and so whether they are certified; a single partition with a gap has
nobody to exchange with.

Defined cases: a null or empty text is one piece that holds only the end id; a long text
is cut into as many pieces as it needs; repeated rows are packed once each; a null doc_id
is packed like any other; equal lengths are placed in the order of their rows; an empty
table gives an empty result; other columns of the table are not read.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CAPACITY = 2048
END_ID = 0
#: Pieces in a partition: a task holds these few numbers of each, however long the texts are.
PER_PARTITION = 20_000
#: Deals in a row that save no bin before the exchange ends.
PATIENCE = 2

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
           path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Cut every document into pieces of at most ``capacity`` tokens (the first is the
    shorter one). ``with_ids`` adds the ids themselves (array of int)."""
    path = path or common.vocabulary("byte_bpe_50k.json")

    def run(batches):
        enc = common.encoder(path, spaces=True)
        for batch in batches:
            for part, texts in common.slices(batch, limit=4 << 20):
                ids, lens = enc.encode(texts)
                out = {k: [] for k in ("row", "piece", "start", "length", "crc", "ids")}
                at = 0
                for row, n in enumerate(lens.tolist()):
                    own = np.append(ids[at:at + n], np.uint32(end_id))
                    at += n
                    edges = list(range(len(own), 0, -capacity))[::-1]
                    begin = 0
                    for k, end in enumerate(edges):
                        out["row"].append(row)
                        out["piece"].append(k)
                        out["start"].append(begin)
                        out["length"].append(end - begin)
                        out["crc"].append(common.crc_of_ids(own[begin:end]))
                        if with_ids:
                            out["ids"].append(own[begin:end].astype(np.int32))
                        begin = end
                rows = [common.column(part, "doc_id").take(pa.array(out["row"], pa.int64())),
                        pa.array(out["piece"], pa.int32()), pa.array(out["start"], pa.int64()),
                        pa.array(out["length"], pa.int64()), pa.array(out["crc"], pa.int64())]
                if with_ids:
                    rows.append(pa.array(out["ids"], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(rows, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return common.id_text(docs).mapInArrow(run, PIECES + ", ids array<int>" * with_ids)


def lower_bound(size: np.ndarray, n: np.ndarray, capacity: int = CAPACITY) -> int:
    """Least number of bins for n[i] items of size[i] (ascending), by two families of
    dual-feasible functions: a function f with sum f(x) <= 1 over any full bin makes
    ceil(sum f) a bound for all items."""
    if not len(size):
        return 0
    size, n = np.asarray(size, np.int64), np.asarray(n, np.int64)
    best = -(-int((size * n).sum()) // capacity)
    # Items over capacity - k count as a whole bin, those under k as nothing.
    whole, mass = np.cumsum(n[::-1])[::-1], np.cumsum((size * n)[::-1])[::-1]
    for k in size[size <= capacity // 2]:
        i, j = np.searchsorted(size, k), np.searchsorted(size, capacity - k, side="right")
        big = int(whole[j]) if j < len(size) else 0
        mid = int(mass[i]) - (int(mass[j]) if j < len(size) else 0)
        best = max(best, big + -(-mid // capacity))
    # Rounded sizes: x where (k + 1) x is whole, else floor((k + 1) x) / k, in exact integers.
    for k in range(1, 101):
        times = (k + 1) * size
        f = np.where(times % capacity == 0, size * k, times // capacity * capacity)  # times k * capacity
        best = max(best, -(-int((f * n).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin of each item, its offset there, number of bins). Open bins are kept by free
    space; one integer has a bit for each free space in use, so the tightest bin that
    fits is its lowest bit from the item's size on."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, used = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = open_bins[free].pop()
            if not open_bins[free]:
                mask ^= 1 << free
        else:
            free, b, used = capacity, used, used + 1
        bins[i], offsets[i] = b, capacity - free
        left = free - size
        if left:
            if not open_bins[left]:
                mask |= 1 << left
            open_bins[left].append(b)
    return bins, offsets, used


PLACED = "uid long, length long, round int, part long, bin long, offset long, fill long, bins long, bound long"


def _pack_parts(items: DataFrame, round_no: int, parts: int, capacity: int) -> DataFrame:
    """items(uid, length) -> PLACED, each of ``parts`` partitions packed by itself."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid", ignore_index=True)
        sizes = pdf["length"].to_numpy(np.int64)
        bins, offsets, used = best_fit_decreasing(sizes, capacity)
        fill = np.bincount(bins, weights=sizes, minlength=used).astype(np.int64)
        return pd.DataFrame({"uid": pdf["uid"], "length": sizes, "round": np.int32(round_no), "part": key[0],
                             "bin": bins, "offset": offsets, "fill": fill[bins], "bins": used,
                             "bound": lower_bound(*np.unique(sizes, return_counts=True), capacity)})

    dealt = items.withColumn("part", F.pmod(F.xxhash64("uid", F.lit(round_no)), F.lit(parts)))
    return dealt.groupBy("part").applyInPandas(run, PLACED)


def _state(placed: DataFrame, capacity: int) -> tuple[int, int, int, int]:
    """(bins of all partitions, the sum of their bounds, partitions with a gap, the
    pieces those can give up): four numbers, summed by Spark."""
    per_part = placed.groupBy("part").agg(
        F.max("bins").alias("bins"), F.max("bound").alias("bound"),
        F.sum((F.col("fill") < capacity).cast("long")).alias("free"))
    gap = F.col("bins") > F.col("bound")
    row = per_part.agg(F.sum("bins"), F.sum("bound"), F.sum(gap.cast("long")), F.sum(F.when(gap, F.col("free")).otherwise(0))).first()
    return tuple(int(x or 0) for x in row)


def pack(cut: DataFrame, capacity: int = CAPACITY, per_partition: int = PER_PARTITION,
         patience: int = PATIENCE) -> DataFrame:
    """Place pieces(doc_id, piece, ..., length): adds sequence_id and offset, and of the
    partition that the piece was packed in bins, bound and certified (bins = bound).

    ``per_partition`` bounds what one task packs; the exchange ends when no two partitions
    have a gap or ``patience`` deals in a row saved no bin (0: no exchange). Pieces that
    fill a sequence need no packing; bins that were filled when their partition gave up
    the others rest as they are, certified by the tokens they hold.
    """
    cut = common.staged(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    whole = [F.lit(1).cast("long").alias("bins"), F.lit(1).cast("long").alias("bound")]
    full = cut.filter(F.col("length") == capacity).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *whole)
    items = cut.filter(F.col("length") < capacity).select("uid", "length")
    parts = common.spread_by_size(items, items.count(), per_partition)
    resting = []
    current = common.staged(_pack_parts(items, 0, parts, capacity), "packed")
    round_no, saved_nothing = 0, 0
    while saved_nothing < patience:
        _, _, gaps, given = _state(current, capacity)
        if gaps < 2 or not given:
            break
        round_no += 1
        released = (F.col("bins") > F.col("bound")) & (F.col("fill") < capacity)
        given_bins = current.filter(released).groupBy("part", "bin").count().count()
        parts = common.spread_by_size(items, given, per_partition)
        again = common.staged(_pack_parts(current.filter(released).select("uid", "length"), round_no, parts, capacity), "packed")
        if _state(again, capacity)[0] >= given_bins:
            saved_nothing += 1  # the packing before stays; the next deal is another one
            continue
        saved_nothing = 0
        resting.append(current.filter(~released))
        current = again
    placed = current
    for more in resting:
        by_tokens = F.when(F.col("bins") > F.col("bound"), F.lit(1)).cast("long")
        placed = placed.unionByName(more.withColumns({"bins": F.coalesce(by_tokens, "bins"), "bound": F.coalesce(by_tokens, "bound")}))
    placed = placed.select("uid", ((F.col("round").cast("long") * (1 << 24) + F.col("part")) * (1 << 32) + F.col("bin")).alias("sequence_id"), "offset", "bins", "bound")
    return cut.join(placed.unionByName(full), "uid").drop("uid").withColumn("certified", F.col("bins") == F.col("bound"))


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences used and the lower bound over all pieces (from the counts of
    the at most ``capacity`` different lengths)."""
    sizes = packed.groupBy("length").agg(F.count("*").alias("n")).orderBy("length").collect()
    bound = lower_bound([r["length"] for r in sizes], [r["n"] for r in sizes], capacity)
    return packed.agg(F.countDistinct("sequence_id").alias("sequences")).withColumn("lower_bound", F.lit(int(bound)))


def sequences(placed_with_ids: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces that carry their ids; a group is at most one
    sequence long."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed_with_ids.groupBy("sequence_id").agg(F.flatten(F.transform(rows, lambda x: x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Placement of all pieces of ``docs``: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset, bins, bound, certified."""
    return pack(pieces(docs, capacity, end_id, path), capacity)
