"""Token-id files compressed by a Re-Pair grammar, with random-access decoding.

Documents are range-partitioned and sorted by doc_id; each partition writes its shard as
files of a few million ids, in order. A file numbers the ids that it holds and repeatedly
replaces the most frequent pairs of neighbouring symbols by new ones (nonterminals), until
no pair is frequent. It stores the ids, the rules, how many ids each rule expands to, and for every document the place of its first symbol, so that a document
or a range of its ids is decoded without the rest of the file.

File bytes, little endian: magic, then six uint32 (first nonterminal, rules, symbols,
documents, symbol width in bytes, 0), then the arrays: the id of each terminal (uint32), rules (left, right), expansion length
of each rule, symbols, doc_id (int64), first symbol and first id of each document and the
ends (uint32), and whether doc_id is null (uint8). Files are kept as binary values of a
Parquet table (shard, file, n_docs, n_tokens, payload), so that Spark's commit protocol
makes each write whole or absent and any store that Spark reads will do.

Defined cases: a null or empty text is just the end id; repeated rows are kept, side by
side; a null doc_id sorts first; an empty table gives files with no documents.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.session import shared_path

from . import common

END_ID = 2
VOCABULARY = 49_408
MAGIC = b"RPTK0002"
FILE_TOKENS = 3 << 19
SHARD_BYTES = 24 << 20
#: The least count of a pair that is replaced. A file's rules end when no pair reaches it;
#: neither their number nor their depth is limited.
MIN_COUNT = 8
_HASH_BITS = 20


def _frequent_pairs(seq: np.ndarray, last: np.ndarray, newest: int = 0, exact: bool = False):
    """(pairs, places, which pair): frequent pairs with a symbol from ``newest`` on, and where they are.

    All pairs are counted in hash cells; of a cell that reaches MIN_COUNT the pair met first
    or last, whichever is the more frequent, is taken if it reaches that count by itself.
    ``exact`` takes all pairs of the cell that do."""
    left, right = seq[:-1], seq[1:]
    places = ~last[:-1]
    if newest:
        places &= (left >= newest) | (right >= newest)
    places = np.flatnonzero(places)
    left, right = left[places], right[places]
    cell = ((left * np.uint32(2654435761) ^ right * np.uint32(2246822519)) >> np.uint32(32 - _HASH_BITS)).astype(np.int64)
    heavy = np.bincount(cell, minlength=1 << _HASH_BITS) >= MIN_COUNT
    some = heavy[cell]
    places, left, right = places[some], left[some], right[some]
    half = np.uint32(16) if int(seq.max()) < 1 << 16 else np.uint64(32)  # both symbols in one number
    key = left.astype(half.dtype) << half | right
    if exact:
        best, slot, count = np.unique(key, return_inverse=True, return_counts=True)
    else:
        slot = (np.cumsum(heavy) - 1)[cell[some]]
        cells = int(heavy.sum())
        best, count = np.zeros(cells, key.dtype), np.zeros(cells, np.int64)
        for step in (1, -1):
            chosen = np.zeros(cells, key.dtype)
            chosen[slot[::step]] = key[::step]
            n = np.bincount(slot[key == chosen[slot]], minlength=cells)
            best, count = np.where(n > count, chosen, best), np.maximum(n, count)
    taken = np.flatnonzero(count >= MIN_COUNT)
    taken = taken[np.argsort(-count[taken], kind="stable")]
    rank = np.full(len(best), -1, np.int64)
    rank[taken] = np.arange(len(taken))
    symbol = rank[slot]
    hit = (symbol >= 0) & (key == best[slot])
    pairs = np.stack([best[taken] >> half, best[taken] & ((half.dtype.type(1) << half) - half.dtype.type(1))], 1).astype(np.uint32)
    return pairs, places[hit], symbol[hit]


def compress(ids: np.ndarray, ends: np.ndarray, base: int = VOCABULARY):
    """Re-Pair over documents ids[ends[i-1]:ends[i]], until no pair reaches MIN_COUNT.
    Returns (rules, expansion lengths, symbols, first symbol of each document and the
    end). No pair spans two documents."""
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    last[ends - 1] = True
    rules = np.zeros((0, 2), np.uint32)
    size = np.ones(base, np.int64)
    newest = 0
    while len(seq) > 1:
        pairs, places, symbol = _frequent_pairs(seq, last, newest)
        if not len(pairs):  # older pairs, and those that share their cells with others
            pairs, places, symbol = _frequent_pairs(seq, last, exact=True)
        if not len(pairs):
            break
        newest = base + len(rules)
        # Neighbouring hits overlap: of each run of them every second one is replaced.
        number = np.arange(len(places), dtype=np.int32)
        start = number.copy()
        start[1:][np.diff(places) == 1] = 0
        np.maximum.accumulate(start, out=start)
        even = (number - start) & 1 == 0
        places, symbol = places[even], symbol[even]
        used = np.bincount(symbol, minlength=len(pairs)) > 0
        pairs, symbol = pairs[used], (np.cumsum(used) - 1)[symbol]
        seq[places] = (base + len(rules) + symbol).astype(np.uint32)
        last[places] = last[places + 1]
        keep = np.ones(len(seq), bool)
        keep[places + 1] = False
        seq, last = seq[keep], last[keep]
        rules = np.concatenate([rules, pairs])
        size = np.concatenate([size, size[pairs].sum(1)])
    firsts = np.concatenate([[0], np.flatnonzero(last) + 1])
    return rules, size[base:], seq, firsts


def pack_file(doc_ids: list, ids: np.ndarray, lens: np.ndarray, base: int = VOCABULARY) -> bytes:
    """The file's bytes; all ids are below ``base``."""
    ends = np.cumsum(lens)
    met = np.bincount(ids, minlength=base) > 0
    terminals = np.flatnonzero(met)
    rules, size, seq, firsts = compress((np.cumsum(met) - 1)[ids], ends, len(terminals))
    width = 2 if len(terminals) + len(rules) <= 1 << 16 else 4
    kind = f"<u{width}"
    head = MAGIC + struct.pack("<6I", len(terminals), len(rules), len(seq), len(lens), width, 0)
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([head, terminals.astype("<u4").tobytes(), rules.astype(kind).tobytes(), size.astype("<u4").tobytes(), seq.astype(kind).tobytes(),
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(), firsts.astype("<u4").tobytes(),
                     np.concatenate([[0], ends]).astype("<u4").tobytes(), nulls.tobytes()])


class TokenFile:
    """A file opened from its bytes; decodes single documents or ranges of their ids."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        self.base, n_rules, n_seq, n_docs, width, _ = struct.unpack_from("<6I", data, 8)
        at = 32

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.terminals = take("<u4", self.base)
        self.rules = take(f"<u{width}", 2 * n_rules).reshape(-1, 2)
        self.size = take("<u4", n_rules)
        self.seq = take(f"<u{width}", n_seq)
        ids = take("<i8", n_docs)
        self.first_symbol, self.first_id = take("<u4", n_docs + 1), take("<u4", n_docs + 1)
        self.doc_ids = [None if null else int(d) for d, null in zip(ids, take("u1", n_docs))]
        self._flat = None

    def _expansions(self):
        """Each symbol's ids in one array: (offset, length) by symbol."""
        if self._flat is None:
            lens = np.concatenate([np.ones(self.base, np.int64), self.size])
            offs = np.cumsum(lens) - lens
            flat = np.zeros(int(lens.sum()), np.uint32)
            flat[:self.base] = self.terminals
            self._flat = offs, lens, flat
            newest, done = np.maximum.accumulate(self.rules.max(1)) if len(self.rules) else [], 0
            while done < len(self.rules):  # rules in a row that only use symbols before them
                stop = max(done + 1, int(np.searchsorted(newest, self.base + done)))
                at = offs[self.base + done]
                more = self.expand(self.rules[done:stop].ravel())
                flat[at:at + len(more)] = more
                done = stop
        return self._flat

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        offs, lens, flat = self._expansions()
        n = lens[symbols]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return flat[np.repeat(offs[symbols] - (ends - n), n) + np.arange(total)]

    def document(self, i: int) -> np.ndarray:
        return self.expand(self.seq[self.first_symbol[i]:self.first_symbol[i + 1]])

    def ids(self, i: int, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of document i: expansion lengths tell which symbols hold them."""
        symbols = self.seq[self.first_symbol[i]:self.first_symbol[i + 1]]
        lens = np.concatenate([np.ones(self.base, np.int64), self.size])[symbols]
        ends = np.cumsum(lens)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skipped = int(ends[a - 1]) if a else 0
        return self.expand(symbols[a:b])[start - skipped:stop - skipped]


FILES = "shard int, file int, n_docs long, n_tokens long, payload binary"


def write(docs: DataFrame, path: str, end_id: int = END_ID, vocabulary: str | None = None, shard_bytes: int = SHARD_BYTES) -> str:
    """Write docs (doc_id, text) as token files under ``path``."""
    place = vocabulary or common.vocabulary("word_bpe_49k.json")
    docs = common.id_text(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))

    def run(batches):
        shard, number = TaskContext.get().partitionId(), 0
        enc = common.encoder(place, spaces=False)
        held, held_lens, held_ids, n = [], [], [], 0

        def flush():
            nonlocal held, held_lens, held_ids, n, number
            lens = np.concatenate(held_lens)
            payload = pack_file(held_ids, np.concatenate(held), lens)
            row = [[shard], [number], [len(lens)], [n], [payload]]
            held, held_lens, held_ids, n, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                                              names=["shard", "file", "n_docs", "n_tokens", "payload"])

        for batch in batches:
            for part, texts in common.slices(batch, limit=4 << 20):
                ids, lens = enc.encode(texts)
                with_end = np.full(len(ids) + len(lens), end_id, np.uint32)
                is_end = np.zeros(len(with_end), bool)
                is_end[np.cumsum(lens + 1) - 1] = True
                with_end[~is_end] = ids
                held.append(with_end)
                held_lens.append(lens + 1)
                held_ids += common.column(part, "doc_id").to_pylist()
                n += len(with_end)
                if n >= FILE_TOKENS:
                    yield flush()
        if n:
            yield flush()

    docs.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id").mapInArrow(run, FILES).write.parquet(path)
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""
    common.find_library(spark)
    files = spark.read.schema(FILES).parquet(path)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                shard, number = (common.column(batch, c)[k].as_py() for c in ("shard", "file"))
                f = TokenFile(common.column(batch, "payload")[k].as_py())
                ids = f.expand(f.seq)
                edges = f.first_id.astype(np.int64)
                crc = [common.crc_of_ids(ids[a:b]) for a, b in zip(edges, edges[1:])]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(f.doc_ids, pa.int64()),
                     pa.array(edges[:-1]), pa.array(np.diff(edges)), pa.array(crc, pa.int64())],
                    names=["shard", "file", "doc_id", "within", "n_tokens", "ids_crc32"])

    rows = files.select("shard", "file", "payload").mapInArrow(run, "shard int, file int, doc_id long, within long, n_tokens long, ids_crc32 long")
    # Ids before each file: files in their shard, shards in the table. Only a row per shard meets in one task.
    shards = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("shard", "file", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("file_start")).join(shards, "shard")
    return rows.join(starts, ["shard", "file"]).select(
        "doc_id", (F.col("shard_start") + F.col("file_start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame) -> DataFrame:
    """Write all documents to a new folder of the shared store and read them back."""
    spark = docs.sparkSession
    return read(spark, write(docs, shared_path(spark, "llm", "token_files", unique=True)))
