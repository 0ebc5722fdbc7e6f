"""Benchmark decontamination: test items whose word shingles a document holds.

Containment is asked from the item's side: the share of its distinct five-word shingles
that occur in the document, at least 0.8. An item of one to four words has one shingle,
all its words, and a document holds it where these words stand in a row anywhere.

Items are partitioned by size. Each has a bottom-k MinHash sketch: with q shingles of
which ceil(0.8 q) must be found, a document may miss at most k - 1 = q - ceil(0.8 q), so it
holds at least one of the item's k shingles with the least hashes. Documents are read once:
a task slides over the words, however long a text is, and asks a screen (a Bloom filter)
whether a run of words may be in a sketch. Documents without such a run are clean. The
others pass on those of their runs that may be any item's shingle, asked of a second
screen. All the rest are joins on the shingles themselves: sketches find the candidate
pairs (of items that fit into the document), and the pairs are verified by exact
containment of the item's shingles.

A screen has at most 2^28 bits (32 MB) whatever the size of the benchmark; no item text is
broadcast or collected. A fuller screen lets more runs pass, which the joins then drop.

Words are the runs between ASCII white space, A-Z in lower case. Defined cases: a null or
empty text has no words and matches nothing; very long texts are read in pieces that
overlap by four words; repeated rows of either table match row by row; null ids are kept as
nulls; further columns of any name pass through ``remove`` unchanged; with an empty table
nothing matches.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SHINGLE = 5
THRESHOLD_PERCENT = 80
#: Bits of a screen for each hash, and the least and the most bits, as powers of two.
BITS_PER_HASH, LEAST_BITS, MOST_BITS = 32, 16, 28
#: Bytes of a long text that are read at a time.
PIECE_BYTES = 4 << 20


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def shingles_of(words: list[bytes], n: int = SHINGLE) -> set[tuple]:
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


_MIX = np.uint64(0x9E3779B97F4A7C15)
#: One multiplier for each of a screen's bits by hash.
_SPREAD = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words, from the words' hashes."""
    many = max(len(words) - n + 1, 0)
    h = np.full(many, n, np.uint64)
    for i in range(n):
        h = (h ^ words[i:i + many]) * _MIX
        h ^= h >> np.uint64(29)
    return h


class Screen:
    """Bits of hashes: ``may_hold`` is true of every hash put in, and of few others."""

    def __init__(self, bits: np.ndarray, log: int):
        self.bits, self.shift = bits, np.uint64(64 - log)

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        """Positions of the hashes that may be held."""
        at = np.arange(len(h))
        for spread in _SPREAD:
            place = (h[at] * spread) >> self.shift
            at = at[(self.bits[place >> np.uint64(3)] >> (np.uint8(7) - (place & np.uint64(7)).astype(np.uint8))) & np.uint8(1) == 1]
        return at


def screen_of(hashes: DataFrame, count: int) -> Screen:
    """The screen of ``count`` hashes(hash); its bits are set in tasks, 8 KB at a time."""
    log = int(np.clip(np.ceil(np.log2(max(count, 1) * BITS_PER_HASH)), LEAST_BITS, MOST_BITS))

    def places(batches):
        for b in batches:
            h = common.column(b, "hash").to_numpy().view(np.uint64)
            place = np.unique(np.concatenate([(h * spread) >> np.uint64(64 - log) for spread in _SPREAD])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place >> 16), pa.array(place & 0xFFFF)], names=["block", "place"])

    def pack(table):
        bits = np.zeros(1 << 16, np.uint8)
        bits[table.column("place").to_numpy()] = 1
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    blocks = hashes.select("hash").mapInArrow(places, "block long, place long").distinct().groupBy("block").applyInArrow(pack, "block long, bits binary")
    bits = np.zeros(1 << (log - 3), np.uint8)
    for r in blocks.collect():  # 2^28 bits at most
        bits[r["block"] << 13:(r["block"] + 1) << 13] = np.frombuffer(r["bits"], np.uint8)
    return Screen(bits, log)


def item_shingles(texts: DataFrame, threshold_percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """The distinct shingles of texts(number, text): number, shingle (words and spaces), hash,
    run (its words), sketch (whether it is one of the k), total, need."""

    def rows_of(number, text: bytes):
        words = text.lower().split()
        n = min(SHINGLE, len(words))
        if not n:
            return
        hashes = run_hashes(word_hashes(words), n).tolist()
        own = {b" ".join(words[i:i + n]): h for i, h in enumerate(hashes)}
        need = -(-threshold_percent * len(own) // 100)
        last = sorted(own.values())[len(own) - need]
        for shingle, h in own.items():
            yield number, shingle, h, n, h <= last, len(own), need

    def run(batches):
        for batch in batches:
            for part, bodies in common.slices(batch):
                rows = [r for number, text in zip(common.column(part, "number").to_pylist(), bodies) for r in rows_of(number, text)]
                c = list(zip(*rows)) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[0], pa.int64()), pa.array(c[1], pa.binary()), pa.array(np.array(c[2], np.uint64).view(np.int64)), pa.array(c[3], pa.int64()),
                     pa.array(c[4], pa.bool_()), pa.array(c[5], pa.int64()), pa.array(c[6], pa.int64())],
                    names=["number", "shingle", "hash", "run", "sketch", "total", "need"])

    return texts.mapInArrow(run, "number long, shingle binary, hash long, run long, sketch boolean, total long, need long")


_GAP = re.compile(rb"[\x20\x09-\x0d]")


def pieces(text: bytes, limit: int = PIECE_BYTES):
    """The text in parts of about ``limit`` bytes, cut between words; each begins with the
    last words of the one before, so that no run of words is lost."""
    start, before = 0, b""
    while len(text) - start > limit:
        gap = _GAP.search(text, start + limit)
        end = gap.start() if gap else len(text)
        piece = before + text[start:end]
        yield piece
        before = b" ".join(piece.rsplit(None, SHINGLE - 1)[1 - SHINGLE:]) + b" "
        start = end
    yield before + text[start:]


class Search:
    """What a task knows of the items: two screens, and the lengths of runs to look at."""

    def __init__(self, sketches: Screen, shingles: Screen, runs: list[int]):
        self.sketches, self.shingles, self.runs = sketches, shingles, runs

    def suspects(self, texts: list[bytes], piece: int = PIECE_BYTES) -> dict[int, tuple[int, dict]]:
        """For texts (by position) that may hold an item: (number of runs looked at, {run of
        words that may be a shingle: whether it may be in a sketch})."""
        short = [i for i, t in enumerate(texts) if len(t) <= piece]
        found = self._look([texts[i] for i in short])
        out = {short[i]: x for i, x in found.items()}
        for i in sorted({*range(len(texts))} - {*short}):
            parts = [x for p in pieces(texts[i], piece) for x in [self._look([p], always=True).get(0)] if x]
            runs: dict = {}
            for _, own in parts:
                for s, m in own.items():
                    runs[s] = m or runs.get(s, False)
            if any(runs.values()):
                out[i] = sum(n for n, _ in parts), runs
        return out

    def _look(self, texts: list[bytes], always: bool = False) -> dict[int, tuple[int, dict]]:
        codes, counts, words = common.word_codes([t.lower() for t in texts])
        h, owner = word_hashes(words)[codes] if len(words) else np.zeros(0, np.uint64), np.repeat(np.arange(len(texts)), counts)
        hits, looked = [], {}
        for n in self.runs:
            runs = run_hashes(h, n)
            at = self.sketches.may_hold(runs)
            hits.append((n, runs, at[owner[at] == owner[at + n - 1]]))
        chosen = np.zeros(len(texts), bool)
        for n, _, at in hits:
            chosen[owner[at]] = True
        if always:
            chosen[:] = True
        if not chosen.any():
            return {}
        for n, runs, sketch in hits:
            at = np.flatnonzero(chosen[owner[:len(runs)]] & (owner[:len(runs)] == owner[n - 1:n - 1 + len(runs)]))
            at = at[self.shingles.may_hold(runs[at])]
            marked = np.zeros(len(runs), bool)
            marked[sketch] = True
            for p in at.tolist():
                shingle = b" ".join([words[c] for c in codes[p:p + n]])
                own = looked.setdefault(int(owner[p]), {})
                own[shingle] = bool(marked[p]) or own.get(shingle, False)
        return {i: (int(counts[i]) * len(self.runs), own) for i, own in looked.items()}


def _columns(items: DataFrame) -> DataFrame:
    return items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))


class Benchmark:
    """Tables of a benchmark: ``texts`` (number, text), each distinct text once, and ``shingles``."""

    def __init__(self, items: DataFrame, threshold_percent: int = THRESHOLD_PERCENT):
        spark = items.sparkSession
        common.find_library(spark)
        # Repeated texts are searched as one.
        self.items = common.staged(_columns(items).filter("text IS NOT NULL").groupBy("text", "item_id").agg(F.count("*").alias("rows")), "items")
        self.texts = common.staged(self.items.select("text").distinct().withColumn("number", F.monotonically_increasing_id()), "item_texts")
        self.shingles = common.staged(item_shingles(self.texts, threshold_percent), "item_shingles")
        sums = self.shingles.groupBy("run").agg(F.count("*").alias("n"), F.count_if("sketch").alias("k")).collect()  # a row for each of five lengths
        runs = sorted(r["run"] for r in sums)
        self.search = Search(screen_of(self.shingles.filter("sketch"), sum(r["k"] for r in sums)),
                             screen_of(self.shingles, sum(r["n"] for r in sums)), runs) if runs else None

    def suspects(self, rows: DataFrame) -> DataFrame:
        """Of rows(row, text): those that may hold an item, with a number of their own, and
        the runs of words that matter."""
        shipped = rows.sparkSession.sparkContext.broadcast(self.search)

        def run(batches):
            count = TaskContext.get().partitionId() << 33
            for batch in batches:
                for part, texts in common.slices(batch):
                    found = shipped.value.suspects(texts)
                    at = list(found)
                    held = [[{"shingle": s, "sketch": m} for s, m in own.items()] for _, own in found.values()]
                    yield pa.RecordBatch.from_arrays(
                        [common.column(part, "row").take(pa.array(at, pa.int64())), pa.array(np.arange(count, count + len(at))), pa.array([n for n, _ in found.values()], pa.int64()),
                         pa.array(held, pa.list_(pa.struct([("shingle", pa.binary()), ("sketch", pa.bool_())])))], names=["row", "uid", "runs", "held"])
                    count += len(at)

        kind = rows.schema["row"].dataType.simpleString()
        return common.staged(rows.mapInArrow(run, f"row {kind}, uid long, runs long, held array<struct<shingle: binary, sketch: boolean>>"), "suspects")

    def clean(self, rows: DataFrame) -> DataFrame:
        """Of rows(row, text): the others."""
        shipped = rows.sparkSession.sparkContext.broadcast(self.search)

        def run(batches):
            for batch in batches:
                for part, texts in common.slices(batch):
                    keep = np.ones(len(texts), bool)
                    keep[list(shipped.value.suspects(texts))] = False
                    yield pa.RecordBatch.from_arrays([common.column(part, "row").filter(pa.array(keep))], names=["row"])

        return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}")

    def matches(self, suspects: DataFrame) -> DataFrame:
        """uid, number, n_shingles, n_found of the suspects that hold an item."""
        held = suspects.select("uid", "runs", F.explode("held").alias("x")).select("uid", "runs", "x.shingle", "x.sketch")
        sketches = self.shingles.filter("sketch").select("number", "shingle", "need")
        pairs = held.filter("sketch").join(sketches, "shingle").filter("need <= runs").select("uid", "number").distinct()
        asked = pairs.join(self.shingles.select("number", "shingle", "total", "need"), "number")
        found = asked.join(held.select("uid", "shingle"), ["uid", "shingle"]).groupBy("uid", "number", "total", "need").agg(F.count("*").alias("n_found"))
        return found.filter("n_found >= need").select("uid", "number", F.col("total").alias("n_shingles"), "n_found")


def find(docs: DataFrame, items: DataFrame, threshold_percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """doc_id, item_id, n_shingles (of the item), n_found of every row of docs that holds an item."""
    given = Benchmark(items, threshold_percent)
    if given.search is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_shingles long, n_found long")
    suspects = given.suspects(common.id_text(docs).select(F.struct("doc_id").alias("row"), "text"))
    found = given.matches(suspects).join(suspects.select("uid", "row.doc_id"), "uid")
    # Back from texts to the benchmark's rows: those of an id and a text as often as they are there.
    rows = given.texts.join(given.items, "text").select("number", "item_id", "rows")
    return found.join(rows, "number").withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).select("doc_id", "item_id", "n_shingles", "n_found")


def remove(docs: DataFrame, items: DataFrame, threshold_percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """The rows of docs that hold no item, with all their columns. Suspects alone are
    written and joined; the clean rows are passed on in a second reading of docs."""
    given = Benchmark(items, threshold_percent)
    if given.search is None:
        return docs
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    suspects = given.suspects(rows)
    kept = suspects.select("uid", "row").join(given.matches(suspects).select("uid").distinct(), "uid", "left_anti").select("row")
    return given.clean(rows).unionByName(kept).select("row.*")


#: The same rows in DuckDB SQL: shingles joined on their words. A document gives its runs of
#: five words, and of as many as a shorter item has.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS item_no, item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
runs AS (SELECT DISTINCT least(len(w), 5) AS n FROM i WHERE len(w) > 0),
ds AS (SELECT DISTINCT row_no, doc_id, n, s FROM (SELECT row_no, doc_id, n, unnest(list_transform(
        range(1, len(w) - n + 2), lambda k: array_to_string(w[k:k + n - 1], ' '))) AS s FROM d, runs WHERE len(w) >= n)),
its AS (SELECT DISTINCT item_no, item_id, n, s FROM (SELECT item_no, item_id, least(len(w), 5) AS n, unnest(list_transform(
        range(1, len(w) - least(len(w), 5) + 2), lambda k: array_to_string(w[k:k + least(len(w), 5) - 1], ' '))) AS s FROM i WHERE len(w) > 0)),
n AS (SELECT item_no, count(*) AS n_shingles FROM its GROUP BY item_no),
hit AS (SELECT row_no, doc_id, item_no, item_id, count(*) AS n_found FROM ds JOIN its USING (n, s) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_found FROM hit JOIN n USING (item_no) WHERE 100 * n_found >= 80 * n_shingles
"""
