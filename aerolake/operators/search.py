"""Lookups, conjunctive searches, sorts and paging (FIL1-6, SRT2-4, LIM1-2).

The reference sends these to a document store and a search service; here they
are filters on a table, so Catalyst pushes the equality predicates into the
Parquet scan, and a page is an ``orderBy().offset().limit()`` that Spark runs as
one ``TakeOrderedAndProject`` (a per-task top-k, then a merge of k rows per
task), never a full sort of the table.
"""

from __future__ import annotations

from functools import reduce
from typing import Any, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from aerolake.operators import relevance
from aerolake.operators.rollups import tokens


def _given(v: Any) -> bool:
    return v is not None and v != ""


def criteria_predicate(criteria: Mapping[str, Any]) -> Column:
    """AND of equality predicates over the given, non-empty criteria; none
    given matches every row (FIL3/FIL4)."""
    preds = [F.col(k) == F.lit(v) for k, v in criteria.items() if _given(v)]
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def lookup_first(df: DataFrame, criteria: Mapping[str, Any], tie: Iterable[str]) -> DataFrame:
    """First match of a conjunctive equality lookup (FIL1, FIL6, LIM2); ``tie``
    makes "first" well defined."""
    return df.where(criteria_predicate(criteria)).orderBy(*tie).limit(1)


def lookup_many(df: DataFrame, keys: DataFrame | None, key_cols: list[str], tie: list[str]) -> DataFrame:
    """The many-key form of ``lookup_first``: first match for every key row
    (``keys=None``: for every key present in ``df``). A semi join plus a min
    over a struct led by the tie columns (partial aggregation, so a popular
    key costs one partial row per task)."""
    matched = df if keys is None else df.join(keys.select(*key_cols).distinct(), key_cols, "left_semi")
    others = [c for c in df.columns if c not in key_cols and c not in tie]
    first = matched.groupBy(*key_cols).agg(F.min(F.struct(*tie, *others)).alias("_m"))
    return first.select(*key_cols, *[F.col(f"_m.{c}").alias(c) for c in tie + others])


def list_matches(df: DataFrame, criteria: Mapping[str, Any], order: list) -> DataFrame:
    """All matches of a conjunctive equality filter, sorted (FIL2, SRT2)."""
    return df.where(criteria_predicate(criteria)).orderBy(*order)


def _sort_columns(df: DataFrame, sort_keys: Iterable[str], descending: Iterable[str] = ()) -> list[Column]:
    desc = set(descending)
    cols = []
    for k in sort_keys:
        if k not in df.columns:  # an unmapped sort field is ignored
            continue
        cols.append(F.col(k).desc_nulls_last() if k in desc else F.col(k).asc_nulls_last())
    return cols


def search(df: DataFrame, criteria: Mapping[str, Any], sort_keys: list[str], tie: list[str],
           start: int = 0, size: int = 20, text_fields: Iterable[str] = (),
           score_col: str = "score") -> DataFrame:
    """One page of a conjunctive search (FIL3/FIL4/FIL7, SRT3/SRT4, LIM1).

    Exact fields filter by equality; ``text_fields`` match when any query
    token occurs and contribute their BM25 score. Order: ``sort_keys``
    ascending with missing values last, then score descending, then ``tie``.
    """
    filtered = searched(df, criteria, text_fields, score_col, digits=None)
    order = _sort_columns(filtered, sort_keys) + [F.col(score_col).desc()] + [F.col(t).asc() for t in tie]
    page = filtered.orderBy(*order).offset(int(start)).limit(int(size))
    return page.withColumn(score_col, F.round(score_col, 6))  # shown rounded, sorted in full


def searched(df: DataFrame, criteria: Mapping[str, Any], text_fields: Iterable[str] = (),
             score_col: str = "score", digits: int | None = 6) -> DataFrame:
    """All rows a search matches, with their relevance score (in full if
    ``digits`` is None)."""
    text = set(text_fields)
    exact = {k: v for k, v in criteria.items() if k not in text}
    out = df.where(criteria_predicate(exact))
    score = F.lit(0.0)
    tmp = []
    for i, field in enumerate(sorted(text)):
        query = criteria.get(field)
        if not _given(query):
            continue
        terms = relevance.query_terms(str(query))
        stats = relevance.corpus_stats(df, field, terms)  # statistics of the whole table
        tk = f"_tk{i}"
        tmp.append(tk)
        out = out.withColumn(tk, tokens(field, lower=True)).where(relevance.match_predicate(F.col(tk), terms))
        score = score + relevance.bm25_score(F.col(tk), terms, stats)
    return out.withColumn(score_col, score if digits is None else F.round(score, digits)).drop(*tmp)


def search_count(df: DataFrame, criteria: Mapping[str, Any], text_fields: Iterable[str] = (),
                 alias: str = "total") -> DataFrame:
    """Total hits of a search, next to its page (AGG3)."""
    text = set(text_fields)
    exact = {k: v for k, v in criteria.items() if k not in text}
    out = df.where(criteria_predicate(exact))
    for field in text:
        if _given(criteria.get(field)):
            terms = relevance.query_terms(str(criteria[field]))
            out = out.where(relevance.match_predicate(tokens(field, lower=True), terms))
    return out.agg(F.count(F.lit(1)).alias(alias))


def keyset_page(df: DataFrame, sort_keys: list[str], after: Mapping[str, Any] | None,
                size: int = 20) -> DataFrame:
    """Deep paging without an offset: rows strictly after ``after`` in the
    ``sort_keys`` order, first ``size`` of them. A missing value sorts last, as
    in ``search``, and a null in ``after`` means that its row had none. Cost is
    that of a top-k whatever the page depth."""
    out = df
    if after:
        cond = F.lit(False)
        for i, k in enumerate(sort_keys):
            same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.lit(after[p])) for p in sort_keys[:i]], F.lit(True))
            if after[k] is not None:  # nothing sorts after a missing value
                cond = cond | (same & ((F.col(k) > F.lit(after[k])) | F.col(k).isNull()))
        out = out.where(cond)
    return out.orderBy(*[F.col(k).asc_nulls_last() for k in sort_keys]).limit(int(size))


def day_range_text(df: DataFrame, col: str, day_from: Column, day_to: Column) -> DataFrame:
    """Closed range on date text (FIL5): ``day_from <= col <= day_to`` as strings."""
    c = F.col(col)
    return df.where((c >= day_from.cast("string")) & (c <= day_to.cast("string")))
