import re

import pytest

import corpus_pipeline
from aerolake.llm import common, decontam, langid, packing, simhash

from .test_decontam import brute as leaks
from .test_packing import brute_pieces, check_layout, none_low
from .test_pii import brute as base_spans
from .test_simhash import brute as brute_simhash

SF = "/root/testdata/sf0.001"


def through(spark, docs, n):
    for name, stage in corpus_pipeline.STAGES[:n]:
        docs = common.staged(stage(spark, docs, SF), name)
    return docs


def test_stages(spark, small_docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "pii", "best_fit_packing"]
    docs = small_docs
    rows = docs.collect()
    known = through(spark, docs, 1).collect()
    model = langid.train(docs)
    labelled = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    want = [r for r in rows if labelled[r["doc_id"]]["lang_pred"] != "und" and labelled[r["doc_id"]]["score"] >= corpus_pipeline.MIN_LANGUAGE_SCORE]
    assert sorted(known) == sorted(want) and len(known) > 0.97 * len(rows)

    firsts = {r[3] for r in brute_simhash(known)}
    unique = through(spark, docs, 2)
    assert unique.columns == docs.columns
    assert sorted(unique.collect()) == sorted(r for r in known if r["doc_id"] in firsts)

    items = [(r["item_id"], r["text"]) for r in decontam.benchmark(spark, SF).collect()]
    held = {x[0] for x in leaks([(r["doc_id"], r["text"]) for r in unique.collect()], items)}
    clean = through(spark, docs, 3)
    assert held and sorted(clean.collect()) == sorted(r for r in unique.collect() if r["doc_id"] not in held)

    safe = {r["doc_id"]: r for r in through(spark, docs, 4).collect()}
    changed = 0
    for r in clean.collect():
        own = safe.pop(r["doc_id"])
        spans = base_spans(r["text"])
        assert not [s for s in spans if r["text"][s[1]:s[2]] in own["text"]]
        if own["text"] == r["text"]:
            assert own == r and not spans
        else:
            changed += 1
            assert own["n_chars"] == len(own["text"]) and re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", own["text"])
            assert (own["lang"], own["source"]) == (r["lang"], r["source"])
    assert not safe and changed

    packed = corpus_pipeline.run(spark, SF).collect()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    final = through(spark, docs, 4).collect()
    assert sorted((tuple(r[k] for k in key) for r in packed), key=none_low) == sorted(brute_pieces(final), key=none_low)
    check_layout(packed)


@pytest.mark.parametrize("which", ["awkward", "no_docs"])
def test_awkward_rows_pass_all_stages(spark, which, request):
    docs = request.getfixturevalue(which)
    out = through(spark, docs, 4)
    assert out.columns == docs.columns
    assert out.count() <= docs.count()
    packing.pack_documents(out).collect()
    assert simhash.fingerprints(out).count() == out.count()
