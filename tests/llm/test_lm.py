import math
import zlib
from collections import Counter

import numpy as np
import pytest

from aerolake.llm import lm


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def fold(doc_id):
    return 5 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def brute(rows):
    """Base figures by the contract, and the model by plain counting."""
    def counts(rows):
        uni, pair = Counter(), Counter()
        for r in rows:
            t = tokens(r["text"])
            uni.update(t)
            pair.update(zip(["start", *t], t))
        return uni, pair, len(rows)

    train = [r for r in rows if fold(r["doc_id"]) != 1]
    uni, pair, starts = counts(train)
    k_uni, k_pair, k_starts = counts([r for r in train if fold(r["doc_id"]) != 0])
    n, v, k_n = sum(uni.values()), len(uni), sum(k_uni.values())
    bucket = lambda c: int(math.floor(math.log2(c))) + 1 if c else 0
    exact = Counter()
    for r in train:
        if fold(r["doc_id"]) == 0:
            t = tokens(r["text"])
            for h, w in zip(["start", *t], t):
                c = k_starts if h == "start" else k_uni[h]
                exact[bucket(c), k_pair[h, w] / max(c, 1), k_uni[w] / max(k_n, 1)] += 1
    weights = lm.em([(b, c, p2, p1) for (b, p2, p1), c in sorted(exact.items())], v)
    out = []
    for r in rows:
        t, base, score = tokens(r["text"]), 0.0, 0.0
        for h, w in zip(["start", *t], t):
            base += math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1)))
            c = starts if h == "start" else uni[h]
            a = weights[bucket(c)]
            score += math.log10(a[0] * pair[h, w] / max(c, 1) + a[1] * uni[w] / max(n, 1) + a[2] / (v + 1)) if n else 0.0
        out.append((r["doc_id"], fold(r["doc_id"]) == 1, len(t), sum(uni[w] > 0 for w in t), n, base, score))
    return out


COLS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


@pytest.mark.parametrize("which,chunk,shard", [("small_docs", 60_000, 20_000), ("awkward", 1 << 20, 10**6), ("no_docs", 1 << 20, 10**6)])
def test_against_plain_counting(which, chunk, shard, request):
    docs = request.getfixturevalue(which)
    got = [tuple(r[c] for c in COLS) for r in lm.score(docs, chunk, shard).collect()]
    want = brute(docs.collect())
    assert sorted((g[:5] for g in got), key=str) == sorted((w[:5] for w in want), key=str)
    for g, w in zip(sorted(got, key=str), sorted(want, key=str)):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] == pytest.approx(w[6], rel=2e-3, abs=0.2)  # weights come from binned sums here


def test_held_out_score_beats_the_base(spark):
    rows = lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
    assert all(r["score"] < 0 for r in rows)


def test_only_held_out_documents(spark):
    ids = [i for i in range(60) if fold(i) == 1]
    docs = spark.createDataFrame([(i, "some words here") for i in ids], "doc_id long, text string")
    assert all((r["score"], r["base_score"], r["n_known"], r["train_tokens"]) == (0.0, 0.0, 0, 0) for r in lm.score(docs).collect())


def test_probabilities_share_one_whole(spark):
    """Texts that differ in one word share at most the probability of what comes before."""
    train = [i for i in range(200) if fold(i) != 1][:60]
    asked = [i for i in range(2000) if fold(i) == 1][:9]
    words = ["a", "b", "c", "d"]
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(words, 12))) for i in train]
    rows += list(zip(asked, ["a " + w for w in [*words, "unknown"]] + ["a"]))
    got = {r["doc_id"]: r["score"] for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = brute([dict(doc_id=i, text=t) for i, t in rows])
    by_id = {r[0]: r[6] for r in first}
    for i in asked[:6]:
        assert got[i] == pytest.approx(by_id[i], abs=0.05)
    assert sum(10 ** got[i] for i in asked[:6]) < 1


def test_packed_hashes_round_trip():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 100_000):
        ids = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        back, used = lm._unpack_ids(lm._pack_ids(ids) + b"rest")
        assert (back == ids).all() and used == len(lm._pack_ids(ids))


def test_em_finds_the_mixture():
    cells = [(4, 100, 0.5, 1e-4)] * 60 + [(4, 100, 0.0, 0.2)] * 30 + [(4, 100, 0.0, 0.0)] * 10
    w = lm.em(cells, 999)[4]
    assert np.allclose(w, [0.6, 0.3, 0.1], atol=0.02)
    assert np.allclose(lm.em(cells, 999).sum(1), 1)


def test_packed_counts_round_trip():
    rng = np.random.default_rng(9)
    for counts in (np.zeros(0, np.int64), np.array([0, 1, 254, 255, 256, 2**40]), rng.integers(0, 300, 5000)):
        data = b"xy" + lm._pack_counts(counts) + lm._pack_counts(counts[::-1])
        back, at = lm._unpack_counts(data, 2)
        again, end = lm._unpack_counts(data, at)
        assert (back == counts).all() and (again == counts[::-1]).all() and end == len(data)
