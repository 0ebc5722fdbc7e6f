"""Language of every word by a linear-chain conditional random field.

A word's features are its byte n-grams (lengths 1 to 4, with marks at both ends, so that
prefixes and suffixes are among them) and the lexicons of frequent words that hold it. The
field adds learned weights for neighbouring languages; forward-backward gives each word the
probability of each language, given the whole text. A document's language is the one with
most probability over its words with a letter.

Documents carry one label for all their words. So that transitions are learned as well,
training sequences are spliced from pieces of labelled documents of different languages.
The fit uses a bounded sample (``SAMPLE_PER_LANG`` rows of each language, a piece of
``SAMPLE_CHARS`` characters at a place drawn by the row's hash); prediction reads whole texts.

Texts are cut into chunks of words; each chunk's transfer matrix is computed for all chunks
at once, and a scan over chunks joins them exactly, however long the text is.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so is any
text when no labelled row was there to learn from; rows with equal ids are labelled row by
row; a null doc_id isn't learned from and isn't held out.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

UNKNOWN = "und"
SAMPLE_PER_LANG = 400
SAMPLE_CHARS = 4000
LEXICON = 300
HASH_BITS = 16
ORDERS = (1, 2, 3, 4)
SEQUENCES = 3000
SEQUENCE_WORDS = 32
EPOCHS = 5
CHUNK = 32
HOLD_OUT = 4, 2  # crc32(doc_id as text) mod 4 is 2

#: An ASCII letter, or a byte of any character beyond ASCII.
_LETTERED = re.compile(rb"[A-Za-z\x80-\xff]")
_ANY_LETTER = re.compile(r"[^\W\d_]")


def ngram_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed n-grams of all words in a row, number of them for each word)."""
    raw = np.frombuffer(b"".join([b"\x01" + w + b"\x02" for w in words]), np.uint8).astype(np.uint64)
    lens = np.array([len(w) + 2 for w in words], np.int64)
    start = np.repeat(np.cumsum(lens) - lens, lens)
    depth = np.arange(len(raw)) - start
    found, places, value = [], [], np.zeros(len(raw), np.uint64)
    for n in ORDERS:
        shifted = np.concatenate([np.zeros(n - 1, np.uint64), raw[:len(raw) - n + 1]])
        value = value | shifted << np.uint64(8 * (n - 1))
        at = np.flatnonzero(depth >= n - 1)
        found.append((value[at] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n * 0xC2B2AE3D27D4EB4F % 2**64)) >> np.uint64(64 - HASH_BITS))
        places.append(at)
    order = np.argsort(np.concatenate(places), kind="stable")
    features = np.concatenate(found)[order].astype(np.int64)
    per_byte = np.minimum(depth + 1, len(ORDERS))
    ends = np.cumsum(lens)
    total = np.concatenate([[0], np.cumsum(per_byte)])
    return features, total[ends] - total[ends - lens]


@dataclass
class Model:
    langs: list[str]
    lexicons: list[frozenset]
    weights: np.ndarray = None
    lexicon_weights: np.ndarray = None
    moves: np.ndarray = None

    def word_features(self, words):
        features, n = ngram_features(words)
        member = np.array([[w in lex for lex in self.lexicons] for w in words], np.float32).reshape(len(words), len(self.langs))
        return features, n, member

    def emissions(self, features, n, member) -> np.ndarray:
        sums = np.add.reduceat(self.weights[features], np.cumsum(n) - n, axis=0)
        return sums / np.sqrt(n)[:, None] + member @ self.lexicon_weights

    def of_words(self, words: list[bytes]) -> np.ndarray:
        """Emission scores of distinct words."""
        parts = [self.emissions(*self.word_features(words[i:i + 10_000])) for i in range(0, len(words), 10_000)]
        return np.concatenate([np.zeros((0, len(self.langs))), *parts])


def _marginals(psi: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word marginals and summed pair marginals of sequences psi[s, t, lang], all of one length."""
    s, t, k = psi.shape
    alpha, beta = np.empty_like(psi), np.empty_like(psi)
    a = np.full((s, k), 1 / k)
    for i in range(t):
        a = (a @ moves) * psi[:, i]
        a /= a.sum(1, keepdims=True)
        alpha[:, i] = a
    b = np.ones((s, k))
    for i in range(t - 1, -1, -1):
        beta[:, i] = b
        b = (psi[:, i] * b) @ moves.T
        b /= b.sum(1, keepdims=True)
    both = alpha * beta
    word = both / both.sum(2, keepdims=True)
    before = np.concatenate([np.full((s, 1, k), 1 / k), alpha[:, :-1]], 1)
    pair = before[..., None] * moves * (psi * beta)[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    return word, pair[:, 1:].sum((0, 1))


def _spliced(docs: list[tuple[str, list[bytes]]], langs: list[str], rng) -> tuple[list[bytes], np.ndarray]:
    """SEQUENCES rows of SEQUENCE_WORDS words, runs of them from random documents."""
    by_lang = [[w for lang, w in docs if lang == x and w] for x in langs]
    words, labels = [], []
    for _ in range(SEQUENCES):
        own = 0
        while own < SEQUENCE_WORDS:
            k = int(rng.integers(len(langs)))
            source = by_lang[k][int(rng.integers(len(by_lang[k])))]
            run = min(SEQUENCE_WORDS - own, 1 + int(rng.geometric(1 / 20)), len(source))
            at = int(rng.integers(len(source) - run + 1))
            words += source[at:at + run]
            labels += [k] * run
            own += run
    return words, np.array(labels).reshape(SEQUENCES, SEQUENCE_WORDS)


def fit(rows: list[tuple[str, str]], seed: int = 11) -> Model | None:
    """rows (lang, text) -> the model, by gradient ascent (AdaGrad) on the conditional likelihood."""
    docs = [(lang, text.encode().lower().split()) for lang, text in rows if lang and text]
    docs = [(lang, w) for lang, w in docs if w]
    langs = sorted({lang for lang, _ in docs})
    if not langs:
        return None
    lexicons = []
    for lang in langs:
        count = Counter(w for x, own in docs if x == lang for w in own)
        lexicons.append(frozenset(sorted(count, key=lambda w: (-count[w], w))[:LEXICON]))
    k = len(langs)
    model = Model(langs, lexicons, np.zeros((1 << HASH_BITS, k), np.float32), np.zeros((k, k)), np.zeros((k, k)))
    rng = np.random.default_rng(seed)
    words, labels = _spliced(docs, langs, rng)
    rate, decay = 0.5, 1e-4
    sums = [np.full(p.shape, 1e-6) for p in (model.weights, model.lexicon_weights, model.moves)]
    batch = 250
    for _ in range(EPOCHS):
        order = rng.permutation(SEQUENCES)
        for at in range(0, SEQUENCES, batch):
            rows_now = order[at:at + batch]
            own = [w for r in rows_now for w in words[r * SEQUENCE_WORDS:(r + 1) * SEQUENCE_WORDS]]
            codes: dict[bytes, int] = {}
            at_word = np.array([codes.setdefault(w, len(codes)) for w in own])
            features, n, member = model.word_features(list(codes))
            scores = model.emissions(features, n, member)[at_word].reshape(len(rows_now), SEQUENCE_WORDS, k)
            moves = np.exp(model.moves)
            word, pair = _marginals(np.exp(scores - scores.max(2, keepdims=True)), moves)
            truth = labels[rows_now]
            by_token = (np.eye(k)[truth] - word).reshape(-1, k)
            error = np.stack([np.bincount(at_word, by_token[:, j], len(codes)) for j in range(k)], 1)
            scaled = error / np.sqrt(n)[:, None]
            row = np.repeat(np.arange(len(n)), n)
            grads = [np.stack([np.bincount(features, scaled[row, j], 1 << HASH_BITS) for j in range(k)], 1), member.T @ error,
                     np.bincount((truth[:, :-1] * k + truth[:, 1:]).ravel(), minlength=k * k).reshape(k, k) - pair]
            for p, g, total in zip((model.weights, model.lexicon_weights, model.moves), grads, sums):
                g = g / len(rows_now) - decay * p
                total += g * g
                p += (rate * g / np.sqrt(total)).astype(p.dtype)
    return model


def _joined(scores: np.ndarray, counts: np.ndarray, moves: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Exact word marginals of all texts: scores of their words in a row, words of each."""
    k = scores.shape[1]
    pieces = -(-counts // chunk)
    first = np.cumsum(pieces) - pieces
    total = int(pieces.sum())
    doc_of = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(scores)) - np.repeat(np.cumsum(counts) - counts, counts)
    row, place = first[doc_of] + within // chunk, within % chunk
    psi = np.ones((total, chunk, k))
    psi[row, place] = np.exp(scores - scores.max(1, keepdims=True))
    filled = np.bincount(row, minlength=total)
    # Transfer matrices: from each language before a chunk to each after it.
    move = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for i in range(chunk):
        live = np.flatnonzero(filled > i)
        step = (move[live] @ moves) * psi[live, i][:, None, :]
        move[live] = step / step.sum((1, 2), keepdims=True)
    before, after = np.full((total, k), 1 / k), np.ones((total, k))
    most = int(pieces.max())
    by_size = np.argsort(-pieces, kind="stable")
    sizes = pieces[by_size]
    for j in range(1, most):
        own = first[by_size[:np.searchsorted(-sizes, -j, "left")]] + j
        a = np.einsum("sk,skl->sl", before[own - 1], move[own - 1])
        before[own] = a / a.sum(1, keepdims=True)
    for j in range(1, most):
        own = by_size[:np.searchsorted(-sizes, -j, "left")]
        at = first[own] + pieces[own] - 1 - j
        b = np.einsum("skl,sl->sk", move[at + 1], after[at + 1])
        after[at] = b / b.sum(1, keepdims=True)
    alpha = np.empty_like(psi)
    a = before
    for i in range(chunk):
        a = (a @ moves) * psi[:, i]
        a /= a.sum(1, keepdims=True)
        alpha[:, i] = a
    b = after
    for i in range(chunk - 1, -1, -1):
        live = (filled > i)[:, None]
        alpha[:, i] *= b
        new = (psi[:, i] * b) @ moves.T
        b = np.where(live, new / new.sum(1, keepdims=True), b)
    out = alpha[row, place]
    return out / out.sum(1, keepdims=True)


def label_words(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """(number of each word among the distinct ones, words of each text, the distinct words,
    probability of each language for all words in a row)."""
    codes, counts, words = common.word_codes([t.lower() for t in texts])
    if not len(codes):
        return codes, counts, words, np.zeros((0, len(model.langs)))
    return codes, counts, words, _joined(model.of_words(words)[codes], counts[counts > 0], np.exp(model.moves))


def label_texts(model: Model | None, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text: the language's mean probability over words with a letter."""
    lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if model is None:
        return lang, score
    codes, counts, words, p = label_words(model, texts)
    lettered = np.array([bool(_LETTERED.search(w)) for w in words], bool)[codes] if len(codes) else np.zeros(0, bool)
    total = np.concatenate([np.zeros((1, len(model.langs))), np.cumsum(p * lettered[:, None], axis=0)])
    number = np.concatenate([[0], np.cumsum(lettered)])
    ends = np.cumsum(counts)
    sums, n = total[ends] - total[ends - counts], number[ends] - number[ends - counts]
    for i in np.flatnonzero(n):
        if not _ANY_LETTER.search(texts[i].decode("utf-8", "replace")):
            continue
        best = int(np.argmax(sums[i]))
        lang[i], score[i] = model.langs[best], min(1.0, max(0.0, float(sums[i][best] / n[i])))
    return lang, score


def held_out():
    n, r = HOLD_OUT
    return F.coalesce(common.crc_mod("doc_id", n) == r, F.lit(False))


def train(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, chars: int = SAMPLE_CHARS) -> Model | None:
    """Fit on a sample of rows with text, lang and an id that isn't held out: each row's
    hash decides, with a threshold that leaves about ``per_lang`` rows of each language."""
    n, r = HOLD_OUT
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (common.crc_mod("doc_id", n) != r))
    sizes = {x["lang"]: x["n"] for x in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = F.create_map(*[F.lit(x) for lang, size in sorted(sizes.items()) for x in (lang, int(min(1.0, per_lang / size) * (1 << 30)) + 1)])
    size = F.length("text")
    begin = 1 + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(size - chars, F.lit(1)))
    sample = rows.filter(draw < share[F.col("lang")]).select("doc_id", "lang", F.substring("text", begin, F.lit(chars)).alias("text"))
    got = sorted((x["doc_id"], x["lang"], x["text"]) for x in sample.collect())
    return fit([(lang, text) for _, lang, text in got])


def _labelled(docs: DataFrame, model: Model | None, keep_rows: bool, min_score: float = 0.0) -> DataFrame:
    common.find_library(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def run(batches):
        own = shipped.value
        for batch in batches:
            for part, texts in common.slices(batch, limit=1 << 20):
                lang, score = label_texts(own, texts)
                if keep_rows:
                    good = [x != UNKNOWN and s >= min_score for x, s in zip(lang, score)]
                    yield part.filter(pa.array(good))
                else:
                    yield pa.RecordBatch.from_arrays([common.column(part, "doc_id"), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    if keep_rows:
        return docs.mapInArrow(run, docs.schema).select(*columns)
    return common.id_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    return _labelled(docs, model, keep_rows=False)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled rows of docs and predict all: doc_id, held_out, lang_pred, score."""
    return predict(docs, train(docs)).withColumn("held_out", held_out())


def keep_known(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Rows of docs whose language is known: not ``und`` and with a score of at least ``min_score``.
    All rows, if there was no labelled row to learn from."""
    model = train(docs)
    return docs if model is None else _labelled(docs, model, keep_rows=True, min_score=min_score)
