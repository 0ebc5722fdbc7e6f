import itertools

import numpy as np
import pytest

from aerolake.llm import langid


def brute_marginals(scores, moves):
    """Word marginals by summing over all label paths."""
    t, k = scores.shape
    out = np.zeros((t, k))
    start = np.full(k, 1 / k) @ moves
    for path in itertools.product(range(k), repeat=t):
        p = start[path[0]] * np.exp(scores[0, path[0]])
        for i in range(1, t):
            p *= moves[path[i - 1], path[i]] * np.exp(scores[i, path[i]])
        for i, x in enumerate(path):
            out[i, x] += p
    return out / out.sum(1, keepdims=True)


def test_chunked_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    counts = np.array([1, 7, 4, 3, 8, 2])
    scores, moves = rng.normal(0, 2, (counts.sum(), 3)), np.exp(rng.normal(0, 1, (3, 3)))
    for chunk in (2, 3, 32):
        got = langid._joined(scores, counts, moves, chunk)
        at = 0
        for n in counts:
            assert np.allclose(got[at:at + n], brute_marginals(scores[at:at + n], moves))
            at += n
    psi = np.exp(scores[:8].reshape(2, 4, 3))
    word, pair = langid._marginals(psi, moves)
    assert np.allclose(word[0], brute_marginals(scores[:4], moves))
    assert np.isclose(pair.sum(), 6)


def test_features_hold_affixes():
    f, n = langid.ngram_features([b"ab", "é".encode(), b""])
    assert n.tolist() == [4 + 3 + 2 + 1] * 2 + [2 + 1]
    g, m = langid.ngram_features([b"ab"])
    assert (f[:10] == g).all() and m.tolist() == [10]
    p, q = langid.ngram_features([b"xyzab"])[0], langid.ngram_features([b"xyzcd"])[0]
    assert len(set(p) & set(q)) >= 3 + 3 + 2  # the shared prefix


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_code_switched_text(small_docs):
    model = langid.train(small_docs)
    rows = {r["lang"]: r["text"].encode().split()[:12] for r in small_docs.filter("length(text) > 600").collect()}
    text = b" ".join(rows["en"] + rows["de"] + rows["es"])
    p = langid.label_words(model, [text])[3]
    truth = ["en"] * 12 + ["de"] * 12 + ["es"] * 12
    assert sum(model.langs[x] == y for x, y in zip(p.argmax(1), truth)) >= 30


def test_lang_source_and_id_are_no_inputs(small_docs):
    from pyspark.sql import functions as F

    model = langid.train(small_docs)
    a = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(small_docs, model).collect())
    other = small_docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert a == sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(other, model).collect())


def test_awkward_rows(awkward, no_docs):
    got = langid.identify(awkward).collect()
    assert len(got) == awkward.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert all(by[i][0]["lang_pred"] == "und" and by[i][0]["score"] == 0 for i in (2, 3, 4))
    assert all(r["lang_pred"] in ("en", "de", "fr", "und") and r["held_out"] is not None for r in got)
    assert langid.identify(no_docs).count() == 0
    kept = langid.keep_known(awkward, 0.0)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 3


@pytest.mark.parametrize("text", ["123 456", "!!! ---", "° ±"])
def test_no_letter_is_und(spark, text, small_docs):
    model = langid.train(small_docs)
    r = langid.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert (r["lang_pred"], r["score"]) == ("und", 0.0)


def test_documents_stay_if_nothing_could_be_learned(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, None)], "doc_id long, text string, lang string")
    assert sorted(langid.keep_known(docs).collect()) == sorted(docs.collect())
