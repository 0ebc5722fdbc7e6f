import pytest
from pyspark.sql import functions as F

from aerolake.operators import pages, relevance, term_table as T
from aerolake.session import shared_path
from conftest import SF_MID
from test_plans import plan

TEXTS = [(1, "the river of the plain"), (2, "river river river"), (3, "of the of the of the of the"), (4, None), (5, ""),
         (6, "The RIVER"), (6, "The RIVER"), (None, "river of doubt"), (7, "nothing here"), (8, "the " * 5000 + "river")]


@pytest.fixture(scope="module")
def small(spark):
    df = spark.createDataFrame(TEXTS, "id long, text string")
    return df, T.build(df, "id", "text", shared_path(spark, "test_terms", unique=True), buckets=4)


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    return df, T.build(df, "doc_id", "text", shared_path(spark, "test_terms", unique=True))


def rows(df):
    return sorted((r[0] is None, r[0] or 0, r[1]) for r in df.collect())


@pytest.mark.parametrize("query", ["the river of", "absent RIVER river", ""])
def test_matches_equal_a_scan(spark, small, query):
    df, path = small
    want = rows(relevance.scored(df, "text", query).select("id", "score"))
    assert rows(T.matches(spark, path, query)) == want
    for k in (3, 100):
        best = sorted(want, key=lambda r: (-r[2], not r[0], r[1]))[:k]
        assert rows(T.top_k(spark, path, query, k)) == sorted(best)


@pytest.mark.parametrize("query", ["the river of", "license under the"])
def test_top_k_of_documents(spark, docs, query):
    df, path = docs
    scored = relevance.scored(df, "text", query, digits=None).select("doc_id", "score").collect()
    for k in (10, 100):
        want = sorted(((r["score"], r["doc_id"]) for r in scored), key=lambda r: (-r[0], r[1]))[:k]
        got = [(r["doc_id"], r["score"]) for r in T.top_k(spark, path, query, k, "doc_id").collect()]
        assert got == [(i, pytest.approx(s, abs=1e-6)) for s, i in want]


def test_bounds_skip_postings_and_words(spark, docs):
    _, path = docs
    counts = spark.read.parquet(f"{path}/levels").groupBy("term").agg(F.sum("n").alias("n"))
    rare = counts.where("n BETWEEN 12 AND 40").orderBy("n", "term").first()["term"]
    common = counts.orderBy(F.col("n").desc(), "term").first()["term"]
    one = T.plan_top_k(spark, path, common, 5)
    assert 0 < one.postings() < one.postings(kept=False) / 2  # low levels of one word are not read
    both = T.plan_top_k(spark, path, f"{rare} {common}", 5)
    assert both.essential == [rare]  # the common word alone can't reach the best rows


def test_plan_reads_the_buckets_of_the_query_alone(spark, docs):
    _, path = docs
    p = plan(T.matches(spark, path, "river"))
    assert "bucket#" in p and f"[{T.bucket_of('river', T.BUCKETS)}]" in p.replace(" ", "") or f"= {T.bucket_of('river', T.BUCKETS)})" in p
    assert "text#" not in p and "PartitionFilters" in p and "EqualTo(term,river)" in p


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, text string")
    path = T.build(df, "id", "text", shared_path(spark, "test_terms", unique=True))
    assert T.top_k(spark, path, "river", 3).collect() == [] and T.matches(spark, path, "river").collect() == []


# --- pages by offset ----------------------------------------------------------

ORDER = ["day", "id"]


@pytest.fixture(scope="module")
def stored(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 9 != 0, F.pmod(F.col("id") * 37, F.lit(50))).alias("day"),
                                  F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("kind"))
    base = shared_path(spark, "test_pages", unique=True)
    return df, pages.build(df, ORDER, f"{base}/all", rows_per_part=64), pages.build(df, ORDER, f"{base}/kind", ["kind"], rows_per_part=64)


def ids(df):
    return [r["id"] for r in df.collect()]


@pytest.mark.parametrize("offset,size", [(0, 10), (63, 2), (500, 150), (995, 50), (1000, 10), (5, 0)])
def test_page_equals_offset_form(spark, stored, offset, size):
    df, path, by_kind = stored
    order = [F.col(c).asc_nulls_last() for c in ORDER]
    assert ids(pages.page_at(spark, path, offset, size)) == ids(df.orderBy(*order).offset(offset).limit(size))
    for kind in ("hot", "c1", "none"):
        want = ids(df.where(F.col("kind") == kind).orderBy(*order).offset(offset // 4).limit(size))
        assert ids(pages.page_at(spark, by_kind, offset // 4, size, {"kind": kind})) == want


def test_page_reads_few_parts(spark, stored):
    _, path, by_kind = stored
    for offset in (0, 500, 980):
        assert 1 <= len(pages.parts_of(spark, path, offset, 10)) <= 2
    assert spark.read.parquet(f"{path}/directory").count() >= 10
    # a hot value lies in many parts, one page of it in two at most
    assert spark.read.parquet(f"{by_kind}/directory").where("kind = 'hot'").count() >= 5
    assert len(pages.parts_of(spark, by_kind, 150, 10, {"kind": "hot"})) <= 2
    p = plan(pages.page_at(spark, path, 500, 10))
    assert "PartitionFilters: [" in p and "_part#" in p


def test_descending_and_empty(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id long, day long")
    path = pages.build(df, ORDER, shared_path(spark, "test_pages", unique=True), descending=("day",))
    assert ids(pages.page_at(spark, path, 0, 3)) == [3, 1, 2]
    path = pages.build(df.where("id > 9"), ORDER, shared_path(spark, "test_pages", unique=True))
    assert ids(pages.page_at(spark, path, 0, 3)) == []
