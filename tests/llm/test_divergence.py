import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from aerolake.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, min_docs=3, top=200):
    """Every pair of sources meets on every kept term."""
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in docs]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        in_docs = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in in_docs.items() if n >= min_docs}
        v = len(kept)
        count = {s: Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in own}}
        whole = sum(count.values(), Counter())
        totals = {id(c): sum(c.values()) for c in [*count.values(), whole]}
        p = lambda c, t: 1 + 10**9 * (c[t] + 1) // (totals[id(c)] + v)
        f = lambda a, b: (a - b) ** 2 // b
        for s, c in count.items():
            pairs = [(sum(f(p(c, t), p(o, t)) for t in kept), x) for x, o in count.items() if x != s]
            terms = [(f(p(c, t), p(whole, t)), t) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, rows, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(rows, key=lambda r: (-r[0], r[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def small(docs):
    return [(r["text"], r["lang"], r["source"]) for r in docs.collect()]


def test_awkward(spark, awkward):
    docs = awkward.unionByName(awkward.withColumn("source", F.lit("z"))).unionByName(awkward.withColumn("lang", F.lit("en")))
    assert sorted(map(tuple, D.audit(docs).collect())) == brute(small(docs))


def test_small_table_equals_brute_force_and_sql(spark, small_docs):
    docs = small_docs.withColumn("source", F.concat("source", F.pmod("doc_id", F.lit(3)).cast("string")))
    got = sorted(map(tuple, D.audit(docs).collect()))
    assert got == brute(small(docs))
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source").toArrow())
    assert sorted(con.execute(D.SQL).fetchall()) == got


def test_slices_and_blocks_change_nothing(spark, small_docs):
    audit = D.Audit(small_docs)
    rows = lambda df: sorted(map(tuple, df.select("lang", "source", "item", "value").collect()))
    assert rows(audit.pairs()) == rows(audit.pairs(slice_entries=150, block=3))


def test_no_documents(spark, no_docs):
    assert D.audit(no_docs).collect() == []


def test_groups_without_terms(spark):
    docs = spark.createDataFrame([(1, "123 ...", "en", "a", 1), (2, None, "en", "b", 1), (3, "rare words", None, None, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(tuple, D.audit(docs).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_long_texts_in_pieces():
    counts = D._Counts()
    text = ("Alpha beta, gamma-delta é " * 4000).encode()
    counts.add([("en", "a"), ("en", "b")], [text, b"beta"])
    whole = list(counts.take())
    assert b"".join(D.pieces(text, 1000)) == text and max(map(len, D.pieces(text, 1000))) < 1100
    counts = D._Counts(1000)
    counts.add([("en", "a"), ("en", "b")], [text, b"beta"])
    key = lambda batches: sorted((r for b in batches for r in b.to_pylist()), key=str)
    assert key(counts.take()) == key(whole)
    assert {r["docs"] for b in whole for r in b.to_pylist() if r["term"]} == {1}


def test_run_length_columns_hold_every_count():
    rng = np.random.default_rng(5)
    for terms, sources in ((1, 1), (40, 3), (300, 45)):
        table = rng.poisson(0.4, (sources, terms))
        table[:, table.sum(0) == 0] = 1
        s, t = np.nonzero(table)
        columns = list(D.run_length_columns(t, s, table[s, t], terms, sources))
        order = {tuple(np.repeat(c, n).tolist()) for c, n in columns}
        got = np.array([np.repeat(c, n) for c, n in columns])
        assert len(order) <= sources
        assert Counter(map(tuple, got.T.tolist())) == Counter(map(tuple, table.T.tolist()))
        assert all((c[1:] != c[:-1]).all() for c, _ in columns)


def test_share_is_exact_for_large_counts():
    for d in (1, 7, 10**9 + 7, 2**52 - 1, 2**60):
        n = np.array([0, 1, d // 3, d - 1])
        assert D.share(n, d).tolist() == [1 + 10**9 * (x + 1) // d for x in n.tolist()]
