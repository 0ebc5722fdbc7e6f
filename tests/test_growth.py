"""Builds whose moved, sorted and kept rows grow no faster than the input."""

import os

from pyspark.sql import functions as F

from aerolake.operators import documents, ml, pages, term_table
from aerolake.plans import QUERIES
from aerolake.plans.catalog import RESULT_DAY
from aerolake.session import shared_path
from aerolake.sources import fixtures, materialize as stored
from aerolake.sources.materialize import materialize
from aerolake.streaming import scoring as sc
from conftest import SF_SMALL
from test_plans import plan


def test_files_of_a_clustered_table_are_small(spark, scratch):
    spark.range(1_600_000).write.parquet(scratch + "/in")
    t = materialize(spark, "growth_files", [scratch + "/in"], lambda: spark.read.parquet(scratch + "/in"), cluster_by=["id"])
    held = [r["count"] for r in t.groupBy(F.input_file_name()).count().collect()]
    assert sum(held) == 1_600_000 and max(held) < 350_000


def test_flights_are_dealt_before_they_are_widened(spark, scratch):
    rows = fixtures.flight_rows(spark, SF_SMALL)
    assert "FlightId" not in rows.columns and len(rows.columns) < len(fixtures.flights(spark, SF_SMALL).columns)
    spark.range(1000).write.parquet(scratch + "/in")
    t = materialize(spark, "growth_finish", [scratch + "/in"], lambda: spark.read.parquet(scratch + "/in"), cluster_by=["day", "text"],
                    files=4, deal_by=["id"], finish=lambda df: df.select((F.col("id") / 100).cast("int").alias("day"), F.col("id").cast("string").alias("text")),
                    rows=lambda: 1000)
    assert sorted((r.day, r.text) for r in t.collect()) == sorted((i // 100, str(i)) for i in range(1000))


def test_parts_of_pages_are_small(spark):
    path = pages.build(spark.range(600_000), ["id"], shared_path(spark, "growth_pages", unique=True))
    held = [r["_rows"] for r in spark.read.parquet(f"{path}/directory").collect()]
    assert sum(held) == 600_000 and max(held) < 350_000
    assert [r.id for r in pages.page_at(spark, path, 299_990, 20).collect()] == list(range(299_990, 300_010))


def test_short_documents_are_gathered_where_they_are_dealt(spark, scratch):
    rows = [("a", None, 1), ("a", 2, 2), ("a", 1, 3), (None, 5, 4), ("b", 1, 5)]
    path = documents.build(spark.createDataFrame(rows, "key string, rank int, value int"), "key", ["rank"], scratch + "/d", page_rows=3)
    got = {r["key"]: ([m["value"] for m in r["members"]], r["page"], r["first"], r["n_members"]) for r in spark.read.parquet(f"{path}/pages").collect()}
    assert got == {"a": ([3, 2, 1], 0, 0, 3), None: ([4], 0, 0, 1), "b": ([5], 0, 0, 1)}
    assert not os.path.exists(f"{path}/sorted")  # no key needs more than a page
    dealt = documents._one_page(spark.range(100).select((F.col("id") % 7).alias("key"), "id").repartitionByRange(3, "key"), "key", ["id"], "members")
    assert plan(dealt).count("- Exchange (") == 1


def test_airplane_documents_are_opened_without_a_join(spark):
    p = plan(QUERIES["airplane_documents"](spark, SF_SMALL))
    assert "Join" not in p and "Exchange" not in p


def test_words_are_counted_within_their_row(spark):
    df = spark.createDataFrame([(0, 10, ["b", "a", "b"]), (1, 11, []), (2, 12, ["c"])], "row long, id long, words array<string>")
    counted = term_table._counted(df)
    assert sorted(map(tuple, counted.collect())) == [(0, 10, 3, "a", 1), (0, 10, 3, "b", 2), (2, 12, 1, "c", 1)]
    assert "Exchange" not in plan(counted)


def test_training_reads_small_splits(spark, monkeypatch):
    key, seen = "spark.sql.files.maxPartitionBytes", []
    own, fit = spark.conf.get(key), ml.Pipeline.fit
    monkeypatch.setattr(ml.Pipeline, "fit", lambda self, data: (seen.append(spark.conf.get(key)), fit(self, data))[1])
    rows = [("A", "X", "Y", "X-Y", float(i), 100.0, 1, 1, 1, float(i % 4)) for i in range(40)]
    df = spark.createDataFrame(rows, "Carrier string, Origin string, Dest string, Route string, DepDelay double, Distance double, "
                                     "DayOfYear int, DayOfMonth int, DayOfWeek int, ArrDelayBucket double")
    ml.train_classifier(df, num_trees=1, max_depth=1)
    assert seen == [ml.TRAIN_SPLIT] and spark.conf.get(key) == own


def test_results_of_a_day_train_on_few_rows_a_task(spark, scratch, monkeypatch):
    def table(name, n, *columns):
        spark.range(n).selectExpr(*columns).coalesce(1).write.parquet(f"{scratch}/{name}.parquet")

    table("nation", 25, "cast(id AS int) AS n_nationkey", "concat('NATION_', id) AS n_name")
    table("customer", 50, "id AS c_custkey", "cast(id % 25 AS int) AS c_nationkey", "element_at(array('BUILDING', 'MACHINERY'), cast(id % 2 + 1 AS int)) AS c_mktsegment")
    table("supplier", 25, "id AS s_suppkey", "cast(id AS int) AS s_nationkey")
    table("part", 40, "id AS p_partkey", "900.0D + id AS p_retailprice")
    table("orders", 600, "id AS o_orderkey", "id % 50 AS o_custkey")
    table("lineitem", 3000, "id % 600 AS l_orderkey", "cast(id % 7 + 1 AS int) AS l_linenumber", "id % 40 AS l_partkey", "id % 25 AS l_suppkey",
          "cast(id % 50 + 1 AS double) AS l_quantity", "timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(cast(id % 900 AS int)) AS l_shipdate")
    table("events", 400, "id AS event_id", f"timestamp_ntz'{RESULT_DAY} 00:00:00' + make_dt_interval(cast(id % 4 AS int) - 1, 5) AS ts", "id AS user_id",
          "if(id % 8 = 1, 'error', 'click') AS event_type", "cast(id AS double) AS value")
    held, fit = [], ml.Pipeline.fit
    # A task reads one file here, as it does of files and splits of the set sizes.
    monkeypatch.setattr(stored, "ROWS_PER_FILE", 100)
    monkeypatch.setattr(ml, "TRAIN_SPLIT", "4m", raising=False)
    monkeypatch.setattr(ml.Pipeline, "fit", lambda self, data: (held.extend(r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()), fit(self, data))[1])
    got = QUERIES["batch_results_for_day"](spark, scratch)
    assert sum(held) == 3000 and max(held) < 300
    # Events 1, 5, 9, ... are of that day; every other one of them is an error.
    assert [r["count"] for r in got.groupBy("in_classes").count().collect()] == [50]
    assert got.where(f"NOT startswith(Timestamp, '{RESULT_DAY}T05:00:00')").isEmpty()


def test_a_store_compares_only_repeated_keys(spark, scratch):
    rows = spark.createDataFrame([("u", 1.0), ("u", 1.0), ("v", 2.0), (None, 3.0), (None, 3.0)], "UUID string, prediction double")
    sc.store_writer(scratch + "/s")(rows, 0)
    got = sc.read_store(spark, scratch + "/s")
    assert sorted(map(str, got.drop("batch_id").collect())) == sorted(map(str, [rows.collect()[i] for i in (0, 2, 3, 4)]))
    assert "LeftAnti" in plan(got)
