"""Nested documents in pages of bounded size (AGG6, AGG7)."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aerolake.operators import documents


def rows_with_a_hot_key(spark, n=3000):
    """A third of the rows have one key; some have none."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 97))
    return spark.range(n).select(key.cast("string").alias("key"), (F.col("id") * 7919 % n).alias("rank"), F.col("id").alias("value"))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    df = rows_with_a_hot_key(spark)
    return df, documents.build(df, "key", ["rank"], str(tmp_path_factory.mktemp("docs") / "d"), page_rows=40, rows_per_part=300)


def test_pages_are_bounded_and_whole(spark, built):
    df, path = built
    want = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        want[r["key"]].append((r["rank"], r["value"]))
    got = defaultdict(list)
    for r in sorted(spark.read.parquet(f"{path}/pages").collect(), key=lambda r: r["page"]):
        assert 1 <= len(r["members"]) <= 40
        assert r["first"] == sum(map(len, got[r["key"]]))
        assert r["page"] == len(got[r["key"]])
        got[r["key"]].append([(m["rank"], m["value"]) for m in r["members"]])
    assert {k: [m for page in v for m in page] for k, v in got.items()} == dict(want)
    assert None in got and len(got["hot"]) >= 25
    assert {r["key"]: (r["n_members"], r["n_pages"]) for r in documents.directory(spark, path).collect()} == {
        k: (len(v), len(got[k])) for k, v in want.items()}


def test_one_document(spark, built):
    df, path = built
    rows = documents.exploded(documents.document(spark, path, "key", "hot"), "key").collect()
    assert [r["place"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1000))
    page = documents.document(spark, path, "key", "hot", page=2)
    assert page.count() == 1
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "EqualNullSafe(key,hot)" in plan or "EqualTo(key,hot)" in plan
    assert documents.document(spark, path, "key", None).count() >= 1
    assert documents.document(spark, path, "key", "nobody").count() == 0


def test_a_hot_key_is_spread_over_parts(spark, built):
    _, path = built
    counted = spark.read.parquet(f"{path}/sorted/directory").where("key = 'hot'").collect()
    assert len(counted) >= 3


def test_empty_table(spark, scratch):
    path = documents.build(rows_with_a_hot_key(spark).where("false"), "key", ["rank"], f"{scratch}/d")
    assert spark.read.parquet(f"{path}/pages").count() == 0
    assert documents.directory(spark, path).count() == 0
