"""Source divergence audit: how far the term use of each source lies from others of its language.

Terms are runs of ASCII letters (A-Z in lower case) and of characters beyond ASCII. A
language keeps the V terms that at least ``MIN_DOCS`` of its documents hold. A group is a
language's source, or the language as a whole; with N occurrences of kept terms in it, a
term that occurs ``count`` times there has p = 1 + floor(10^9 (count + 1) / (N + V)). The
divergence of a group from another one, whose value for the term is q, is the sum of
floor((p - q)^2 / q) over all kept terms. All arithmetic is in integers.

The sums over pairs of sources use run-length columns. p depends on a term's count alone,
so within a slice of a language's vocabulary the terms are put in an order that clusters
equal counts (lexicographic by the counts of the sources with the most terms), and each
source becomes a column of runs of equal counts, the terms it doesn't hold included.
For a pair, the run boundaries of both columns are intersected, and one value for each
common run is multiplied by its length. Slices are dealt by the terms' hash, so a hot
source is spread over all of them; above ``BLOCK`` sources a slice's columns are dealt
further to pairs of source blocks. Only sums of slices are added up by pair.

Defined cases: null text, lang or source count as ''; rows with one doc_id, or none, are
documents of their own; a group without kept terms, or a language without any, is in all
results that name it (values 0 where V = 0); an empty table gives an empty result. Very
long texts are read in pieces that end between two terms. The values of a group sum to
less than 2^63 as long as V is below 10^9.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

MIN_DOCS = 3
TOP_TERMS = 200
UNIT = 1_000_000_000
#: (term, source) entries in a slice of a language's vocabulary, on average.
SLICE_ENTRIES = 200_000
#: Sources whose columns meet in one task.
BLOCK = 128
#: Sources by which a slice's terms are ordered.
ORDER_BY = 32
#: Distinct (group, term) pairs, and terms, that a counting task holds before it passes them on.
HELD = 400_000
#: Bytes of a long text that are read at a time.
PIECE_BYTES = 4 << 20

_APART = np.zeros(256, bool)
_APART[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_GAP = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")


def pieces(text: bytes, limit: int = PIECE_BYTES):
    """The text in parts of about ``limit`` bytes that end between two terms."""
    start = 0
    while len(text) - start > limit:
        gap = _GAP.search(text, start + limit)
        end = gap.end() if gap else len(text)
        yield text[start:end]
        start = end
    yield text[start:]


class _Counts:
    """Occurrences and documents of each (group, term) that a task has met."""

    def __init__(self, piece: int = PIECE_BYTES):
        self.piece = piece
        self.groups, self.terms = {}, {}
        self.keys, self.sums = [], []  # keys are group << 32 | term; sums are (occurrences, documents)
        self.size = 0

    def _codes(self, texts: list[bytes]):
        """(term of each occurrence, occurrences of each text)."""
        codes, counts, words = common.word_codes([t.lower() for t in texts], _APART)
        return np.array([self.terms.setdefault(w, len(self.terms)) for w in words], np.int64)[codes], counts

    def add(self, groups: list[tuple], texts: list[bytes]):
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in groups], np.int64)
        short = [i for i, t in enumerate(texts) if len(t) <= self.piece]
        codes, counts = self._codes([texts[i] for i in short])
        self._count(np.repeat(group[short], counts), codes, np.repeat(np.arange(len(short)), counts))
        for i in {*range(len(texts))} - {*short}:
            held = np.zeros(0, np.int64)
            for piece in pieces(texts[i], self.piece):
                codes, _ = self._codes([piece])
                new = np.setdiff1d(codes, held)
                self._count(np.full(len(codes), group[i]), codes, None)
                self._put((group[i] << 32) | new, np.zeros(len(new), np.int64), np.ones(len(new), np.int64))
                held = np.union1d(held, new)

    def _count(self, group, codes, document):
        key, n = np.unique((group << 32) | codes, return_counts=True)
        docs = np.zeros(len(key), np.int64)
        if document is not None:
            # (document, term) once each; a document has one group
            both = np.unique((document.astype(np.int64) << 32) | codes, return_index=True)[1]
            own, m = np.unique((group[both] << 32) | codes[both], return_counts=True)
            docs[np.searchsorted(key, own)] = m
        self._put(key, n, docs)

    def _put(self, key, n, docs):
        self.keys.append(key)
        self.sums.append(np.stack([n, docs]))
        self.size += len(key)
        if self.size > 4 * HELD:
            self._compact()

    def _compact(self):
        if not self.keys:
            return
        key, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        sums = np.zeros((2, len(key)), np.int64)
        for row, parts in zip(sums, np.concatenate(self.sums, axis=1)):
            np.add.at(row, at, parts)
        self.keys, self.sums, self.size = [key], [sums], len(key)

    def full(self) -> bool:
        if self.size > HELD:
            self._compact()
        return self.size > HELD or len(self.terms) > HELD

    def take(self):
        """What was counted, as batches; and a row without a term for each group met."""
        self._compact()
        groups, terms = list(self.groups), pa.array(list(self.terms), pa.binary())
        lang, source = (pa.array([g[c] for g in groups], pa.string()) for c in range(2))
        none = pa.array([0] * len(groups), pa.int64())
        yield pa.RecordBatch.from_arrays([lang, source, pa.nulls(len(groups), pa.binary()), none, none], names=_NAMES)
        for i in range(0, self.size, 65536):
            key, (n, docs) = self.keys[0][i:i + 65536], self.sums[0][:, i:i + 65536]
            group = pa.array(key >> 32)
            yield pa.RecordBatch.from_arrays([lang.take(group), source.take(group), terms.take(pa.array(key & 0xFFFFFFFF)),
                                              pa.array(n), pa.array(docs)], names=_NAMES)


_NAMES = ["lang", "source", "term", "n", "docs"]


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it); term is null in
    one more row for each group, with or without terms."""
    common.find_library(docs.sparkSession)

    def run(batches):
        counts = _Counts()
        for batch in batches:
            for part, texts in common.slices(batch):
                counts.add(list(zip(common.column(part, "lang").to_pylist(), common.column(part, "source").to_pylist())), texts)
                if counts.full():
                    yield from counts.take()
                    counts = _Counts()
        if counts.groups:
            yield from counts.take()

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    found = docs.select(*text).mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return found.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: np.ndarray, d: int) -> np.ndarray:
    """p of terms with the given counts, d = N + V: long division in base 1000 keeps longs exact."""
    rest = n.astype(np.int64) + 1
    if d >= 1 << 53:
        return np.array([1 + UNIT * int(x) // d for x in rest.tolist()], np.int64)
    out, rest = rest // d, rest % d
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // d, rest % d
    return out + 1


def run_length_columns(term: np.ndarray, source: np.ndarray, n: np.ndarray, terms: int, sources: int):
    """For each source, (counts, lengths) of its runs over all terms, in a common order of
    the terms that clusters equal counts."""
    held = np.bincount(source, minlength=sources)
    rank = np.full(sources, ORDER_BY)
    first = np.argsort(-held, kind="stable")[:ORDER_BY]
    rank[first] = np.arange(len(first))
    dense = np.zeros((len(first), terms), np.int64)
    some = rank[source] < len(first)
    dense[rank[source[some]], term[some]] = n[some]
    place = np.empty(terms, np.int64)
    place[np.lexsort(dense[::-1])] = np.arange(terms)
    order = np.lexsort((place[term], source))
    place, n, edges = place[term][order], n[order], np.concatenate([[0], np.cumsum(held)])
    for s in range(sources):
        at, value = place[edges[s]:edges[s + 1]], n[edges[s]:edges[s + 1]]
        starts = np.union1d(np.concatenate([[0], at]), at + 1)
        starts = starts[starts < terms]
        hit = np.searchsorted(at, starts)
        counts = np.zeros(len(starts), np.int64)
        own = hit < len(at)
        own[own] = at[hit[own]] == starts[own]
        counts[own] = value[hit[own]]
        new = np.concatenate([[True], counts[1:] != counts[:-1]])[:len(starts)]
        starts, counts = starts[new], counts[new]
        yield counts, np.diff(np.concatenate([starts, [terms]]))


def common_runs(ends_a: np.ndarray, ends_b: np.ndarray):
    """(run of a, run of b, length) of the runs that two columns over the same terms have in common."""
    ends = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends), np.diff(ends, prepend=0)


def _columns(table: pa.Table) -> pa.Table:
    """The run-length columns of one slice of a language's vocabulary."""
    sources = table.column("source").combine_chunks().dictionary_encode()
    names, source = sources.dictionary, sources.indices.to_numpy()
    entries = np.flatnonzero(table.column("term").combine_chunks().is_valid().to_numpy(zero_copy_only=False))
    own = table.take(pa.array(entries))
    terms = own.column("term").combine_chunks().dictionary_encode()
    d = np.zeros(len(names), object)
    block = np.zeros(len(names), np.int64)
    for s, x, b in zip(source.tolist(), table.column("d").to_pylist(), table.column("block").to_pylist()):
        d[s], block[s] = x, b
    runs = list(run_length_columns(terms.indices.to_numpy().astype(np.int64), source[entries].astype(np.int64),
                                   own.column("n").to_numpy().astype(np.int64), len(terms.dictionary), len(names)))
    many = len(names)
    return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * many, pa.string()), "slice": pa.array([table.column("slice")[0].as_py()] * many, pa.int64()),
                     "blocks": pa.array([table.column("blocks")[0].as_py()] * many, pa.int64()), "source": names.cast(pa.string()), "d": pa.array(d.tolist(), pa.int64()),
                     "block": pa.array(block), "counts": pa.array([c for c, _ in runs], pa.list_(pa.int64())), "lengths": pa.array([x for _, x in runs], pa.list_(pa.int64()))})


def _pairs(table: pa.Table) -> pa.Table:
    """Sums over one slice of all pairs of two source blocks, both ways."""
    x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
    block, names, d = (table.column(c).to_pylist() for c in ("block", "source", "d"))
    lengths = [np.array(v, np.int64) for v in table.column("lengths").to_pylist()]
    ends = [np.cumsum(v) for v in lengths]
    p = [share(np.array(c, np.int64), k) if len(c) else np.zeros(0, np.int64) for c, k in zip(table.column("counts").to_pylist(), d)]
    left, right = [i for i, b in enumerate(block) if b == x], [i for i, b in enumerate(block) if b == y]
    out = []
    for i in left:
        for j in right:
            if x == y and j <= i:
                continue
            a, b, length = common_runs(ends[i], ends[j])
            pa_, pb = p[i][a], p[j][b]
            square = (pa_ - pb) ** 2
            out.append((names[i], names[j], int((square // pb * length).sum())))
            out.append((names[j], names[i], int((square // pa_ * length).sum())))
    lang = table.column("lang")[0].as_py()
    return pa.table([pa.array([lang] * len(out), pa.string()), *(pa.array([r[c] for r in out], t) for c, t in enumerate((pa.string(), pa.string(), pa.int64())))],
                    names=["lang", "source", "item", "value"])


class Audit:
    """The tables of an audit: ``groups`` (lang, source, d = N + V, sources, entries of the
    language, d_lang) and ``entries`` (lang, source, term, n, total in the language)."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        counts = common.staged(term_counts(docs), "divergence_counts")
        kept = common.staged(counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
                             .filter(F.col("docs") >= min_docs).select("lang", "term", "total"), "divergence_kept")
        self.entries = common.staged(counts.filter("term IS NOT NULL").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "total"), "divergence_entries")
        groups = counts.filter("term IS NULL").select("lang", "source").join(
            self.entries.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count("*").alias("own")), ["lang", "source"], "left").fillna(0, ["n", "own"])
        langs = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.sum("own").alias("lang_entries")).join(
            kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n")), "lang", "left").fillna(0, ["v", "lang_n"])
        self.groups = common.staged(groups.join(langs, "lang").select(
            "lang", "source", (F.col("n") + F.col("v")).alias("d"), (F.col("lang_n") + F.col("v")).alias("d_lang"), "sources", "lang_entries"), "divergence_groups")

    def pairs(self, slice_entries: int = SLICE_ENTRIES, block: int = BLOCK) -> DataFrame:
        """lang, source, item (another source of the language), value."""
        slices = F.ceil(F.col("lang_entries") / slice_entries).cast("long")
        blocks = F.ceil(F.col("sources") / block).cast("long")
        facts = self.groups.select("lang", "source", "d", F.greatest(slices, F.lit(1)).alias("slices"), blocks.alias("blocks"),
                                   F.pmod(F.xxhash64("source"), blocks).alias("block"))
        names = ["lang", "slice", "blocks", "source", "d", "block", "term", "n"]
        entries = self.entries.join(facts, ["lang", "source"]).withColumn("slice", F.pmod(F.xxhash64("term"), F.col("slices"))).select(*names)
        # Every source has a column in every slice, if only one of zeros.
        every = facts.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))).select(
            "lang", "slice", "blocks", "source", "d", "block", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"))
        columns = entries.unionByName(every).groupBy("lang", "slice").applyInArrow(
            _columns, "lang string, slice long, blocks long, source string, d long, block long, counts array<long>, lengths array<long>")
        met = columns.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
            "lang", "slice", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "source", "d", "block", "counts", "lengths")
        return met.groupBy("lang", "slice", "x", "y").applyInArrow(_pairs, "lang string, source string, item string, value long").groupBy(
            "lang", "source", "item").agg(F.sum("value").alias("value"))

    def terms(self, top: int = TOP_TERMS) -> DataFrame:
        """lang, source, item (a term used more than in the whole language), value, rank up to ``top``."""
        share_of = lambda n, d: F.expr(f"1 + CAST((CAST({n} + 1 AS DECIMAL(19, 0)) * CAST({UNIT} AS DECIMAL(10, 0))) div {d} AS LONG)")
        rows = self.entries.join(self.groups.select("lang", "source", "d", "d_lang"), ["lang", "source"]).select(
            "lang", "source", F.col("term").alias("item"), share_of("n", "d").alias("p"), share_of("total", "d_lang").alias("q")).filter("p > q")
        return _ranked(rows.select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))).filter(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    found = Audit(docs, min_docs)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return _ranked(found.pairs()).withColumn("part", F.lit("pair")).select(*columns).unionByName(
        found.terms(top).withColumn("part", F.lit("term")).select(*columns))


#: The same rows in DuckDB SQL: every pair of sources meets on every kept term.
SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rn, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
occ AS (SELECT rn, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM occ GROUP BY lang, term HAVING count(DISTINCT rn) >= 3),
langs AS (SELECT lang, count(term) AS v, coalesce(sum(total), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang),
own AS (SELECT lang, source, term, count(*) AS c FROM occ JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN own USING (lang, source) GROUP BY ALL),
p AS (SELECT grp.lang, grp.source, kept.term, coalesce(c, 0) AS c,
        1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (grp.n + langs.v) AS p, 1 + (1000000000::HUGEINT * (total + 1)) // (langs.n + langs.v) AS q
    FROM grp JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN own ON own.lang = grp.lang AND own.source = grp.source AND own.term = kept.term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
