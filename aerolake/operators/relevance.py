"""Full-text match with BM25 relevance (FIL7).

A field matches when it shares at least one token with the query (a ``match``
query's default OR). The score is the published BM25 sum over query terms:

    idf(t)   = ln(1 + (N - df(t) + 0.5) / (df(t) + 0.5))
    score(d) = sum_t idf(t) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))

Corpus statistics (N, avgdl and df of each query term) come from ONE global
aggregation over the whole table; the query has few terms, so the result is a
handful of numbers. Term frequencies are then computed per row from the row's
own token array, so scoring is a narrow, shuffle-free projection.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from aerolake.operators.rollups import python_tokens, tokens

# The usual BM25 parameters.
K1 = 1.2
B = 0.75


def query_terms(query: str) -> list[str]:
    seen: list[str] = []
    for t in python_tokens(query, lower=True):
        if t not in seen:
            seen.append(t)
    return seen


def _tf(toks: Column, term: str) -> Column:
    return F.size(F.filter(toks, lambda x: x == F.lit(term)))


def corpus_stats(df: DataFrame, text_col: str, terms: list[str]) -> dict:
    """N, avgdl and df per term over the whole table (one aggregation job)."""
    tk = df.select(tokens(text_col, lower=True).alias("_tk"))
    aggs = [F.count(F.lit(1)).alias("N"), F.avg(F.size("_tk")).alias("avgdl")]
    aggs += [F.sum(F.array_contains("_tk", t).cast("long")).alias(f"df{i}") for i, t in enumerate(terms)]
    row = tk.agg(*aggs).first()
    return {"N": row["N"], "avgdl": row["avgdl"] or 0.0,
            "df": [row[f"df{i}"] or 0 for i in range(len(terms))]}


def bm25_score(toks: Column, terms: list[str], stats: dict, k1: float = K1, b: float = B,
               tfs: list[Column] | None = None) -> Column:
    """Per-row BM25 score of a token-array column for the query terms (0 if
    no match). ``tfs`` may pass precomputed term-frequency columns."""
    if tfs is None:
        tfs = [_tf(toks, t).cast("double") for t in terms]
    return bm25_sum(F.size(toks).cast("double"), tfs, stats, k1, b)


def bm25_sum(dl: Column, tfs: list[Column], stats: dict, k1: float = K1, b: float = B) -> Column:
    """BM25 score from a row's length and its frequency of each query term."""
    avgdl = stats["avgdl"] or 1.0
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl / F.lit(avgdl))
    total = F.lit(0.0)
    for tf, dfreq in zip(tfs, stats["df"]):
        idf = math.log(1.0 + (stats["N"] - dfreq + 0.5) / (dfreq + 0.5))
        total = total + F.lit(idf) * tf * F.lit(k1 + 1.0) / (tf + norm)
    return F.coalesce(total, F.lit(0.0))


def match_predicate(toks: Column, terms: list[str]) -> Column:
    """True when the token array shares at least one token with the query
    (a query without tokens matches nothing)."""
    if not terms:
        return F.lit(False)
    return F.arrays_overlap(toks, F.array(*[F.lit(t) for t in terms]))


def scored(df: DataFrame, text_col: str, query: str, score_col: str = "score",
           digits: int | None = 6) -> DataFrame:
    """Rows of ``df`` whose ``text_col`` matches ``query``, plus their score.
    Each text is tokenised once, in its own projection."""
    terms = query_terms(query)
    if not terms:
        return df.where(F.lit(False)).withColumn(score_col, F.lit(0.0))
    stats = corpus_stats(df, text_col, terms)
    with_tk = df.withColumn("_tk", tokens(text_col, lower=True))
    hit = with_tk.where(match_predicate(F.col("_tk"), terms))
    # one pass over the token array per term; each count is used twice below
    tf_cols = [f"_tf{i}" for i in range(len(terms))]
    hit = hit.select("*", *[_tf(F.col("_tk"), t).cast("double").alias(c) for t, c in zip(terms, tf_cols)])
    score = bm25_score(F.col("_tk"), terms, stats, tfs=[F.col(c) for c in tf_cols])
    if digits is not None:
        score = F.round(score, digits)
    return hit.withColumn(score_col, score).drop("_tk", *tf_cols)


def match_relevance(df: DataFrame, text_col: str, query: str, id_cols=(), digits: int | None = 6,
                    score_col: str = "score") -> DataFrame:
    """Rows whose ``text_col`` matches ``query``, with their BM25 score."""
    cols = list(id_cols) + [text_col] if id_cols else list(df.columns)
    return scored(df.select(*cols), text_col, query, score_col, digits)
