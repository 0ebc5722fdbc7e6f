import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aerolake.llm import tokenfile
from aerolake.llm.common import crc_of_ids


def brute(rows):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, at = [], 0
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        out.append((r["doc_id"], at, len(ids), crc_of_ids(np.array(ids))))
        at += len(ids)
    return out


@pytest.mark.parametrize("which", ["small_docs", "awkward", "no_docs"])
def test_round_trip(which, request):
    docs = request.getfixturevalue(which)
    got = [tuple(r) for r in tokenfile.round_trip(docs).orderBy("start").collect()]
    assert got == brute(docs.collect())


def test_shards_follow_one_another(small_docs, scratch, spark):
    path = tokenfile.write(small_docs, f"{scratch}/files", shard_bytes=50_000)
    assert spark.read.parquet(path).select("shard").distinct().count() > 3
    assert [tuple(r) for r in tokenfile.read(spark, path).orderBy("start").collect()] == brute(small_docs.collect())


def test_grammar_and_random_access():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 40, int(n)).astype(np.uint32) for n in rng.integers(1, 400, 60)] + [np.full(5000, 7, np.uint32), np.tile(np.arange(6), 500).astype(np.uint32)]
    lens = np.array([len(d) for d in docs])
    data = tokenfile.pack_file([*range(len(docs) - 1), None], np.concatenate(docs), lens, base=50)
    f = tokenfile.TokenFile(data)
    assert f.doc_ids[-1] is None and len(f.rules)
    assert len(f.seq) < lens.sum() * 0.6 and f.size.max() > 8
    for i, d in enumerate(docs):
        assert (f.document(i) == d).all()
        for _ in range(5):
            a, b = sorted(rng.integers(0, len(d) + 1, 2).tolist())
            assert (f.ids(i, a, b) == d[a:b]).all()


def test_pairs_are_replaced_until_none_is_frequent():
    rng = np.random.default_rng(3)
    copies = np.tile(rng.integers(0, 40_000, 1000), 40)  # one passage, often repeated
    rare = rng.integers(0, 40_000, 300_000)
    twice = np.repeat(rng.permutation(20_000).reshape(-1, 2), 8, axis=0)[rng.permutation(80_000)].ravel()  # 10,000 pairs, 8 times each
    docs = [x.astype(np.uint32) for x in (copies, rare, *twice.reshape(-1, 2), *np.tile(np.arange(30_000, 46_000).reshape(-1, 2), (9, 1)))]
    lens = np.array([len(d) for d in docs])
    rules, size, seq, firsts = tokenfile.compress(np.concatenate(docs), np.cumsum(lens))
    assert len(rules) > 16_128 and size.max() >= 64
    same = np.ones(len(seq), bool)
    same[firsts[1:] - 1] = False
    left = np.flatnonzero(same)
    assert np.unique(np.stack([seq[left], seq[left + 1]], 1), axis=0, return_counts=True)[1].max() < tokenfile.MIN_COUNT
    f = tokenfile.TokenFile(tokenfile.pack_file([*range(len(docs))], np.concatenate(docs), lens))
    assert (f.expand(f.seq) == np.concatenate(docs)).all() and (f.document(1) == docs[1]).all()
    assert (f.ids(0, 999, 2003) == docs[0][999:2003]).all()
