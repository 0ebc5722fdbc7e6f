"""Summaries kept up to date from appended files."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from aerolake.operators import incremental, rollups

SUMMARIES = {"routes": incremental.route_distance(), "months": incremental.flights_by_month(), "carriers": incremental.airplanes_per_carrier()}


def flights(spark, begin, end):
    i = F.col("id")
    return spark.range(begin, end, numPartitions=2).select(
        F.concat(F.lit("A"), i % 5).alias("Origin"), F.when(i % 11 > 0, F.concat(F.lit("B"), i % 3)).alias("Dest"),
        F.when(i % 4 > 0, i % 100).cast("double").alias("Distance"), (i % 3 + 2000).cast("int").alias("Year"), (i % 12 + 1).cast("int").alias("Month"),
        F.concat(F.lit("C"), i % 4).alias("Carrier"), F.concat(F.lit("N"), i % 37).alias("TailNum"))


def rows(df):
    return sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def same_as_full(spark, source, store):
    whole = spark.read.parquet(source)
    for name, want in (("routes", rollups.route_distance(whole)), ("months", rollups.flights_by_month(whole)),
                       ("carriers", rollups.airplanes_per_carrier(whole))):
        assert rows(incremental.result(spark, store, name, SUMMARIES[name])) == rows(want), name


def test_three_appends_read_new_files_only(spark, scratch):
    source, store = f"{scratch}/in", f"{scratch}/store"
    for n in range(3):
        flights(spark, n * 500, n * 500 + 700).write.mode("append").parquet(source)
        assert incremental.refresh(spark, source, store, SUMMARIES) == 2
        same_as_full(spark, source, store)
    assert incremental.refresh(spark, source, store, SUMMARIES) == 0
    read = incremental.result(spark, store, "routes", SUMMARIES["routes"]).inputFiles()
    assert read and not any(f"{scratch}/in" in f for f in read)


def test_generations_are_merged(spark, scratch):
    source, store = f"{scratch}/in", f"{scratch}/store"
    for n in range(4):
        flights(spark, n * 50, n * 50 + 90).write.mode("append").parquet(source)
        incremental.refresh(spark, source, store, SUMMARIES, merge_at=3)
    assert len(incremental._state(spark, store)["generations"]) == 2
    assert incremental.refresh(spark, source, store, SUMMARIES, merge_at=3) == 0
    same_as_full(spark, source, store)


def test_a_rewritten_input_is_read_anew(spark, scratch):
    source, store = f"{scratch}/in", f"{scratch}/store"
    flights(spark, 0, 300).write.parquet(source)
    incremental.refresh(spark, source, store, SUMMARIES)
    flights(spark, 100, 900).write.mode("overwrite").parquet(source)
    assert incremental.refresh(spark, source, store, SUMMARIES) == 2
    same_as_full(spark, source, store)


def test_two_refreshes_at_a_time(spark, scratch, monkeypatch):
    source, store = f"{scratch}/in", f"{scratch}/store"
    flights(spark, 0, 300).write.parquet(source)
    empty = incremental._state(spark, store)
    incremental.refresh(spark, source, store, SUMMARIES)
    with monkeypatch.context() as m, pytest.raises(AnalysisException):
        m.setattr(incremental, "_state", lambda *a: empty)  # began before the other had ended
        incremental.refresh(spark, source, store, SUMMARIES)
    same_as_full(spark, source, store)


def test_nothing_yet(spark, scratch):
    with pytest.raises(ValueError):
        incremental.result(spark, f"{scratch}/none", "routes", SUMMARIES["routes"])
    flights(spark, 0, 0).write.parquet(f"{scratch}/in")
    incremental.refresh(spark, f"{scratch}/in", f"{scratch}/store", SUMMARIES)
    assert incremental.result(spark, f"{scratch}/store", "months", SUMMARIES["months"]).count() == 0


def test_refresh_job(spark, scratch):
    from aerolake import jobs

    flights(spark, 0, 300).write.parquet(f"{scratch}/in")
    assert jobs.run_refresh(spark, f"{scratch}/in", f"{scratch}/store", f"{scratch}/out") == 2
    flights(spark, 300, 500).write.mode("append").parquet(f"{scratch}/in")
    assert jobs.run_refresh(spark, f"{scratch}/in", f"{scratch}/store", f"{scratch}/out") == 2
    assert rows(spark.read.parquet(f"{scratch}/out/months")) == rows(rollups.flights_by_month(spark.read.parquet(f"{scratch}/in")))
