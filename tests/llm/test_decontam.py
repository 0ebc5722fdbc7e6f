import random

import pytest

from aerolake.llm import decontam

ITEMS = "item_id long, text string"


def brute(docs, items):
    out, words = [], [(d, (x or "").encode().lower().split()) for d, x in docs]
    held_by = {n: [(d, decontam.shingles_of(w, n) if len(w) >= n else set()) for d, w in words] for n in range(1, 6)}
    for i, t in items:
        own = (t or "").encode().lower().split()
        n = min(5, len(own))
        own = decontam.shingles_of(own)
        for d, held in held_by.get(n, ()):
            if own and 100 * len(own & held) >= 80 * len(own):
                out.append((d, i, len(own), len(own & held)))
    return sorted(out, key=str)


def made(seed=6):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("aeiou") * rng.randint(1, 2)
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 3, 4, 5, 6, 9, 20, 40, 90])))) for i in range(40)] + [(99, None), (98, ""), (None, "some item without id here"), (97, "a b")]
    docs = [(1000, None), (1001, ""), (1002, "a  B"), (None, "x some item WITHOUT id here y")]
    for d in range(300):
        text = [word() for _ in range(rng.choice([0, 3, 10, 100, 800]))]
        if d % 2:
            own = items[rng.randrange(40)][1].split()
            for _ in range(rng.randint(0, len(own) // 8)):
                own[rng.randrange(len(own))] = "CHANGED"
            if rng.random() < 0.3:
                own = own[:len(own) // 2] + ["apart"] * 3 + own[len(own) // 2:]
            at = rng.randint(0, len(text))
            text[at:at] = [w.upper() if rng.random() < 0.2 else w for w in own]
        docs.append((d, rng.choice([" ", "\n", "\t "]).join(text)))
    return docs, items


@pytest.mark.parametrize("bits", [28, 8])
def test_against_brute_force(spark, monkeypatch, bits):
    """Also with screens so small that they let almost everything pass."""
    monkeypatch.setattr(decontam, "MOST_BITS", max(bits, 16))
    monkeypatch.setattr(decontam, "BITS_PER_HASH", 32 if bits == 28 else 0.01)
    docs, items = made()
    want = brute(docs, items)
    assert len(want) > 50
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    got = sorted((tuple(r) for r in decontam.find(d, i).collect()), key=str)
    assert got == want
    kept = sorted((tuple(r) for r in decontam.remove(d, i).collect()), key=str)
    hit = {x[0] for x in want}
    assert kept == sorted((x for x in docs if x[0] not in hit), key=str)


def test_given_tables(small_docs, spark):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in small_docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert sorted((tuple(r) for r in decontam.find(small_docs, items).collect()), key=str) == want


def test_awkward_and_empty(awkward, no_docs, spark):
    items = spark.createDataFrame([(1, "one two three four five six. One two!")], ITEMS)
    assert sorted(r["doc_id"] for r in decontam.find(awkward, items).collect()) == [1, 1, 8]
    assert decontam.remove(awkward, items).columns == awkward.columns
    assert decontam.find(no_docs, items).count() == 0
    assert decontam.find(awkward, items.limit(0)).count() == 0
    assert decontam.remove(awkward, items.limit(0)).count() == awkward.count()


def test_repeated_items(spark):
    items = [(1, "one two three four five six")] * 500 + [(2, "one two three four five six"), (3, "seven eight nine ten eleven")]
    docs = [(10, "zero one two three four five six"), (11, "nothing of these words is there")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    given = decontam.Benchmark(i)
    assert given.texts.count() == 2
    assert sorted(tuple(r) for r in decontam.find(d, i).collect()) == brute(docs, items)
    assert [r["doc_id"] for r in decontam.remove(d, i).collect()] == [11]


def test_short_items_inside_long_documents(spark):
    items = [(1, "Capital of France Paris"), (2, "blue"), (3, "so-called  test item"), (4, "of France"), (5, "one two three four five"), (6, "not there")]
    long = "filler text " * 300
    docs = [(1, long + "that the capital of france Paris is big " + long), (2, "capital of France, Paris"), (3, "Blue"), (4, "bluer than blues"),
            (5, "so-called\n test\titem"), (6, "a one two three four"), (7, "one two three four five"), (8, "of"), (9, None)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    got = sorted(tuple(r) for r in decontam.find(d, i).collect())
    assert [r[:2] for r in got] == [(1, 1), (1, 4), (3, 2), (5, 3), (7, 5)] and got == brute(docs, items)
    assert sorted(r["doc_id"] for r in decontam.remove(d, i).collect()) == [2, 4, 6, 8, 9]
    import duckdb

    con = duckdb.connect()
    con.register("documents", d.toArrow())
    con.register("benchmark", i.toArrow())
    assert sorted(con.execute(decontam.SQL).fetchall()) == got


def test_clashing_columns_of_both_tables(spark, awkward):
    docs = awkward.select("*", *[awkward["source"].alias(c) for c in ("row", "held", "runs", "shingle", "number")])
    items = spark.createDataFrame([(1, "one two three four five six. One two!", "?", "?", "?")], ITEMS + ", number string, rows string, sketch string")
    assert sorted(r["doc_id"] for r in decontam.find(docs, items).collect()) == [1, 1, 8]
    out = decontam.remove(docs, items)
    assert out.columns == docs.columns and out.count() == docs.count() - 3


def test_pieces_lose_no_run_of_words():
    text = b" ".join(str(k).encode() for k in range(3000)) + b"  \n x" * 50 + b"y" * 700
    whole = decontam.shingles_of(text.split())
    parts = list(decontam.pieces(text, 100))
    assert len(parts) > 50 and set().union(*(decontam.shingles_of(p.split()) for p in parts)) >= whole
    assert set().union(*({s for s in decontam.shingles_of(p.split()) if len(s) == 5} for p in parts)) == whole


def test_screen_holds_all_hashes(spark):
    rows = spark.range(5000).selectExpr("xxhash64(id) AS hash")
    screen = decontam.screen_of(rows, 5000)
    import numpy as np

    h = np.array([r["hash"] for r in rows.collect()]).view(np.uint64)
    assert len(screen.may_hold(h)) == 5000 and len(screen.may_hold(h ^ np.uint64(0x5555))) < 100
