"""Language-model scores by deleted interpolation of word bigrams and unigrams.

p(w | h) = a f(w | h) + b f(w) + c / (V + 1), with maximum-likelihood f from the training
documents and weights a, b, c for each bucket of the context's count c(h). The weights are
learned by expectation-maximisation on a deleted part of the training documents, against
counts of the kept part; then all training documents count.

All counts are of the whole corpus, and no table of them is ever in one place:

1. Documents are read once and written as chunks: token numbers and the chunk's distinct
   words, as 64-bit hashes. A chunk holds documents of one role: kept, deleted or held out.
2. Each chunk asks for its distinct unigrams and bigrams: sorted hashes, cut by range into
   shards, with its own counts. A shard adds up what all chunks say of its range and
   answers each chunk in the order of its question. A very frequent word or pair is one
   entry of each chunk, so no shard gets more because of it.
3. Chunks meet their answers: deleted ones give the weights' statistics (sums in cells of
   context bucket and probability, a fixed number of cells), then all are scored.

Words are the runs between ASCII white space, A-Z in lower case; each text ends with one
end token. Two different words or pairs are taken for one only if their 64-bit hashes agree.

Defined cases: a null or empty text is just the end token; repeated rows count and are
scored once each; a row without doc_id is a training row; without any training row
every probability is that of one unknown word, 1; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CHUNK_BYTES = 12 << 20
#: Entries of all chunks that a shard adds up at a time.
SHARD_TOKENS = 3_000_000
FOLDS, HELD_OUT, DELETED = 5, 1, 0
KEPT_ROLE, DELETED_ROLE, TEST_ROLE = 0, 1, 2
BINS_PER_OCTAVE = 4
EM_ROUNDS = 200

START = np.uint64(0x5354415254000001)
END = np.uint64(0x454E440000000001)
#: What an unseen text's lowest bin is.
_NO_BIN = -1000


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two."""
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (a >> np.uint64(31))
    h = (h + b) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0x165667B19E3779F9)
    return h ^ (h >> np.uint64(29))


CHUNKS = "chunk long, role int, n_tokens long, doc_ids array<long>, n_words array<int>, words binary, tokens binary"


def _chunk_row(chunk: int, role: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
    codes, counts, words = common.word_codes([t.lower() for t in texts])
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T  # high bytes together pack well
    packed = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())
    row = [[chunk], [role], [len(codes) + len(texts)], [ids], [counts.tolist()], [hashes.tobytes()], [packed]]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=["chunk", "role", "n_tokens", "doc_ids", "n_words", "words", "tokens"])


def chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The corpus as chunks, written once."""
    fold = F.coalesce(common.crc_mod("doc_id", FOLDS), F.lit(FOLDS))
    role = F.when(fold == HELD_OUT, TEST_ROLE).when(fold == DELETED, DELETED_ROLE).otherwise(KEPT_ROLE)
    docs = common.id_text(docs).withColumn("role", role)

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        held = {r: ([], []) for r in (KEPT_ROLE, DELETED_ROLE, TEST_ROLE)}
        size = dict.fromkeys(held, 0)
        for batch in batches:
            roles, ids = common.column(batch, "role").to_pylist(), common.column(batch, "doc_id").to_pylist()
            texts = common.column(batch, "text").cast(pa.binary()).to_pylist()
            for r, i, t in zip(roles, ids, texts):
                held[r][0].append(i)
                held[r][1].append(t or b"")
                size[r] += len(t) if t else 0
                if size[r] >= chunk_bytes:
                    yield _chunk_row(task << 32 | number, r, *held[r])
                    number += 1
                    held[r], size[r] = ([], []), 0
        for r, (ids, texts) in held.items():
            if ids:
                yield _chunk_row(task << 32 | number, r, ids, texts)
                number += 1

    return common.staged(docs.mapInArrow(run, CHUNKS), "lm_chunks")


class _Chunk:
    """A chunk's tokens: hashes of each token and the one before, and of their pair."""

    def __init__(self, n_words, words: bytes, tokens: bytes):
        n_words = np.asarray(n_words, np.int64)
        self.words = np.frombuffer(words, np.uint64)
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(tokens, max_output_size=4 * int(n_words.sum()) + 4), np.uint8)
        codes = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel().astype(np.int64) if len(raw) else np.zeros(0, np.int64)
        self.lens = n_words + 1
        self.ends = np.cumsum(self.lens)
        # Numbers of tokens: the words', then the end's and the start's.
        self.token = np.full(int(self.lens.sum()), len(self.words), np.int64)
        is_word = np.ones(len(self.token), bool)
        is_word[self.ends - 1] = False
        self.token[is_word] = codes
        self.before = np.concatenate([[0], self.token[:-1]])
        self.before[self.ends - self.lens] = len(self.words) + 1
        self.hashes = np.concatenate([self.words, [END, START]]).astype(np.uint64)

    def unigrams(self):
        """(sorted hashes, where each of them is among ``hashes``)."""
        order = np.argsort(self.hashes, kind="stable")
        return self.hashes[order], order

    def unigram_counts(self):
        n = np.bincount(self.token, minlength=len(self.hashes))
        n[-1] = len(self.lens)  # a start for each text
        return n

    def pairs(self):
        return _mix(self.hashes[self.before], self.hashes[self.token])


def _pack_ids(ids: np.ndarray) -> bytes:
    """Sorted hashes as differences, of as many bytes as the largest needs."""
    steps = np.diff(ids, prepend=np.uint64(0))
    width = max(1, (int(steps[1:].max(initial=np.uint64(0))).bit_length() + 7) // 8)
    head = np.array([len(ids), width, ids[0] if len(ids) else 0], "<u8").tobytes()
    return head + steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack_ids(data: bytes) -> tuple[np.ndarray, int]:
    n, width, first = (int(x) for x in np.frombuffer(data, "<u8", 3))
    out = np.zeros((max(n, 1), 8), np.uint8)
    used = 24 + (n - 1) * width
    out[1:n, :width] = np.frombuffer(data, np.uint8, (n - 1) * width, 24).reshape(-1, width)
    steps = out.view("<u8").ravel()
    steps[0] = first
    return np.cumsum(steps, dtype=np.uint64)[:n], used


def _pack_counts(counts: np.ndarray) -> bytes:
    """A byte for each count; the few of 255 or more follow with their places."""
    large = np.flatnonzero(counts >= 255)
    head = np.array([len(counts), len(large)], "<u4").tobytes()
    return head + np.minimum(counts, 255).astype(np.uint8).tobytes() + large.astype("<u4").tobytes() + counts[large].astype("<u8").tobytes()


def _unpack_counts(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    n, n_large = (int(x) for x in np.frombuffer(data, "<u4", 2, at))
    out = np.frombuffer(data, np.uint8, n, at + 8).astype(np.int64)
    at += 8 + n
    out[np.frombuffer(data, "<u4", n_large, at)] = np.frombuffer(data, "<u8", n_large, at + 4 * n_large)
    return out, at + 12 * n_large


REQUESTS = "kind int, shard int, chunk long, role int, payload binary"
REPLIES = "chunk long, kind int, shard int, payload binary"


def _requests(blocks: DataFrame, shards: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = _Chunk(row["n_words"], row["words"], row["tokens"])
                ids, order = c.unigrams()
                pairs, n = np.unique(c.pairs(), return_counts=True)
                out = []
                for kind, ids, counts in ((1, ids, c.unigram_counts()[order]), (2, pairs, n)):
                    shard = ((ids >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
                    edges = np.searchsorted(shard, np.arange(shards + 1))
                    for s in np.flatnonzero(np.diff(edges)):
                        a, b = edges[s], edges[s + 1]
                        out.append((kind, int(s), row["chunk"], row["role"], _pack_ids(ids[a:b]) + _pack_counts(counts[a:b])))
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["kind", "shard", "chunk", "role", "payload"])

    return blocks.select("chunk", "role", "n_words", "words", "tokens").mapInArrow(run, REQUESTS)


def _answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Add up a shard. Answers hold, in the order asked, each entry's count in all training
    documents and, for deleted chunks, in the kept ones. The unigram shards also tell N, V and the kept N."""
    got = [(_unpack_ids(p), p) for p in rows["payload"]]
    sizes = [len(ids) for (ids, _), _ in got]
    every = np.concatenate([ids for (ids, _), _ in got])
    counts = np.concatenate([_unpack_counts(p, used)[0] for (_, used), p in got])
    role = np.repeat(rows["role"].to_numpy(), sizes)
    order = np.argsort(every, kind="stable")
    fresh = np.concatenate([[True], every[order][1:] != every[order][:-1]])
    first = np.flatnonzero(fresh)
    where = np.empty(len(every), np.int64)
    where[order] = np.cumsum(fresh) - 1
    counts = counts[order]
    kept = np.add.reduceat(np.where(role[order] == KEPT_ROLE, counts, 0), first)
    train = np.add.reduceat(np.where(role[order] != TEST_ROLE, counts, 0), first)
    at = np.concatenate([[0], np.cumsum(sizes)])
    payload = [_pack_counts(train[where[a:b]]) + (_pack_counts(kept[where[a:b]]) if r == DELETED_ROLE else b"")
               for a, b, r in zip(at, at[1:], rows["role"])]
    chunk = rows["chunk"].tolist()
    if key[0] == 1:
        words = every[order][first] != START
        payload.append(np.array([train[words].sum(), (train[words] > 0).sum(), kept[words].sum()], "<i8").tobytes())
        chunk.append(-1)
    return pd.DataFrame({"chunk": chunk, "kind": key[0], "shard": key[1], "payload": payload})


def _counts(replies: pd.DataFrame, kind: int, which: int) -> np.ndarray:
    """A chunk's counts of a kind, by sorted hash: in the training (0) or the kept documents (1)."""
    out = [np.zeros(0, np.int64)]
    for p in replies[replies["kind"] == kind].sort_values("shard")["payload"]:
        found, at = _unpack_counts(p)
        out.append(_unpack_counts(p, at)[0] if which else found)
    return np.concatenate(out)


def _bucket(context: np.ndarray) -> np.ndarray:
    """Bucket of a context's count: 0 for none, then by powers of two."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0)


def _looked_up(block: pd.DataFrame, replies: pd.DataFrame, which: int):
    """(chunk, count of each token, of the word before, of both) in the ``which`` counts."""
    r = block.iloc[0]
    c = _Chunk(r["n_words"], r["words"], r["tokens"])
    _, order = c.unigrams()
    uni = np.empty(len(c.hashes), np.int64)
    uni[order] = _counts(replies, 1, which)
    _, where = np.unique(c.pairs(), return_inverse=True)
    pair = _counts(replies, 2, which)[where]
    return c, uni[c.token], uni[c.before], pair


def _learn(blocks: DataFrame, replies: DataFrame, kept_n: int, v: int) -> np.ndarray:
    """Weights (bigram, unigram, uniform) for each bucket, by EM over the deleted chunks."""

    def cells(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        names = ["bucket", "bin2", "bin1", "n", "p2", "p1"]
        if block.empty:
            return pd.DataFrame({k: pd.Series(dtype="float64" if k in ("p2", "p1") else "int64") for k in names})
        _, word, context, pair = _looked_up(block, answers, 1)
        p2, p1 = pair / np.maximum(context, 1), word / max(kept_n, 1)
        bins = [np.where(p > 0, np.floor(BINS_PER_OCTAVE * np.log2(np.maximum(p, 1e-300))).astype(np.int64), _NO_BIN) for p in (p2, p1)]
        frame = pd.DataFrame({"bucket": _bucket(context), "bin2": bins[0], "bin1": bins[1], "n": 1, "p2": p2, "p1": p1})
        return frame.groupby(names[:3], as_index=False).sum()[names]

    deleted = blocks.filter(F.col("role") == DELETED_ROLE)
    found = deleted.groupBy("chunk").cogroup(replies.join(deleted.select("chunk"), "chunk", "left_semi").groupBy("chunk")).applyInPandas(
        cells, "bucket long, bin2 long, bin1 long, n long, p2 double, p1 double")
    rows = found.groupBy("bucket", "bin2", "bin1").agg(F.sum("n").alias("n"), F.sum("p2").alias("p2"), F.sum("p1").alias("p1")).orderBy("bucket", "bin2", "bin1").collect()
    return em([(r["bucket"], r["n"], r["p2"] / r["n"], r["p1"] / r["n"]) for r in rows], v)


def em(cells: list[tuple], v: int, rounds: int = EM_ROUNDS, buckets: int = 64) -> np.ndarray:
    """cells (bucket, tokens, mean bigram, mean unigram probability) -> weights[bucket].
    A bucket without tokens takes the next lower one's; the first is the plain mixture."""
    weights = np.zeros((buckets, 3))
    last = np.array([0.0, 0.9, 0.1])
    for b in range(buckets):
        own = [(n, p2, p1) for bucket, n, p2, p1 in cells if bucket == b]
        if own:
            n, p2, p1 = np.array(own, float).T
            p = np.stack([p2, p1, np.full(len(n), 1 / (v + 1))], 1)
            w = np.array([0.3, 0.4, 0.3]) if b else np.array([0.0, 0.6, 0.4])
            for _ in range(rounds):
                part = w * p
                part /= np.maximum(part.sum(1, keepdims=True), 1e-300)
                w = (n[:, None] * part).sum(0)
                w = (w + [1e-3 * (b > 0), 1e-3, 1e-3]) / (w.sum() + 2e-3 + 1e-3 * (b > 0))
            last = w
        weights[b] = last
        if b == 0 and last[0] == 0:
            last = np.array([0.05, 0.85 * last[1], 0])  # a seen context may at least be used
            last[2] = 1 - last[:2].sum()
    weights[0] = [0, weights[0][1] / max(weights[0][1:].sum(), 1e-300), weights[0][2] / max(weights[0][1:].sum(), 1e-300)]
    return weights


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    blocks = chunks(docs, chunk_bytes)
    total = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    replies = common.staged(_requests(blocks, shards).groupBy("kind", "shard").applyInPandas(_answer, REPLIES), "lm_replies")
    n = v = kept_n = 0
    for r in replies.filter("chunk = -1").select("payload").toLocalIterator():  # a row for each shard
        a, b, c = np.frombuffer(r["payload"], "<i8")
        n, v, kept_n = n + int(a), v + int(b), kept_n + int(c)
    replies = replies.filter("chunk <> -1")
    weights = _learn(blocks, replies, kept_n, v)

    def scored(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if block.empty:
            return pd.DataFrame({"doc_id": pd.Series(dtype="Int64")}).reindex(columns=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
        c, word, context, pair = _looked_up(block, answers, 0)
        w = weights[_bucket(context)]
        p = w[:, 0] * (pair / np.maximum(context, 1)) + w[:, 1] * (word / max(n, 1)) + w[:, 2] / (v + 1)
        if not n:
            p = np.ones(len(word))
        base = np.log10((word + 0.5) / (n + 0.5 * (v + 1)))
        at = c.ends - c.lens
        r = block.iloc[0]
        return pd.DataFrame({"doc_id": pd.array([None if x is None or x != x else int(x) for x in r["doc_ids"]], "Int64"), "held_out": r["role"] == TEST_ROLE, "n_tokens": c.lens,
                             "n_known": np.add.reduceat((word > 0).astype(np.int64), at), "base_score": np.add.reduceat(base, at),
                             "score": np.add.reduceat(np.log10(p), at)})

    out = blocks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(scored, SCORES)
    return out.withColumn("train_tokens", F.lit(n).cast("long"))
