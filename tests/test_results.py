import pytest
from pyspark.sql import functions as F

from aerolake.session import shared_path
from aerolake.streaming import results as R
from aerolake.streaming.scoring import read_store, store_writer
from test_plans import plan

SCHEMA = "UUID string, prediction double, extra int"


@pytest.fixture()
def store(spark):
    base = shared_path(spark, "test_results", unique=True)
    return f"{base}/store", f"{base}/index"


def put(spark, store, n, rows):
    store_writer(store)(spark.createDataFrame(rows, SCHEMA), n)


def batch(n, size=60):
    return [(f"u{n}-{i}", float(i % 4), n) for i in range(size)]


def statuses(spark, store, uuids):
    asked = spark.createDataFrame([(u,) for u in uuids], "UUID string")
    return sorted(map(tuple, R.poll_many(spark, *store, asked).collect()), key=str)


def test_poll_before_during_and_after_compaction(spark, store):
    path, index = store
    assert R.poll(spark, path, index, "u0-1").collect()[0]["status"] == "WAIT"
    asked = [f"u{n}-{i}" for n in range(5) for i in range(0, 60, 17)] + ["nobody"]
    for n in range(4):
        put(spark, path, n, batch(n))
        before = statuses(spark, store, asked)
        R.compact(spark, path, index, buckets=8, merge_at=3)
        assert statuses(spark, store, asked) == before
    put(spark, path, 4, batch(4))  # not folded yet
    want = {r["UUID"]: r for r in read_store(spark, path).collect()}
    for row in statuses(spark, store, asked):
        own = want.get(row[0])
        assert row == ((row[0], "OK", own["prediction"], own["extra"]) if own else (row[0], "WAIT", None, None))
    for u in ("u0-17", "u3-34", "u4-0", "nobody"):
        assert [tuple(r) for r in R.poll(spark, path, index, u).collect()] == [r for r in statuses(spark, store, [u])]
    assert len(R._state(spark, index)["generations"]) == 2 and R._state(spark, index)["folded"] == [0, 1, 2, 3]
    assert R.compact(spark, path, index)["folded"] == [0, 1, 2, 3, 4]
    before = R.versions(spark, index)
    R.compact(spark, path, index)  # nothing new: nothing published
    assert R.versions(spark, index) == before


def test_repeated_and_missing_ids(spark, store):
    path, index = store
    put(spark, path, 0, [("a", 1.0, 0), ("b", None, 0), (None, 1.0, 0), (None, 1.0, 0)])
    put(spark, path, 1, [("a", 2.0, 1), ("c", 3.0, 1)])
    R.compact(spark, path, index, buckets=4, merge_at=2)
    put(spark, path, 2, [("c", 0.0, 2), ("d", 0.0, 2), (None, 0.0, 2)])
    put(spark, path, 10, [("d", 1.0, 10)])
    want = [("a", "OK", 1.0, 0), ("b", "OK", None, 0), ("c", "OK", 3.0, 1), ("d", "OK", 0.0, 2)]
    assert statuses(spark, store, "abcd") == want
    R.compact(spark, path, index, merge_at=2)  # the second generation: merged with the first
    state = R._state(spark, index)
    assert len(state["generations"]) == 1 and statuses(spark, store, "abcd") == want
    kept = spark.read.parquet(f"{index}/{state['generations'][0]}")
    assert kept.where("UUID IS NULL").count() == 3 and kept.count() == 7


def test_poll_reads_one_bucket(spark, store):
    path, index = store
    put(spark, path, 0, batch(0, 400))
    R.compact(spark, path, index, buckets=8)
    one = R.poll(spark, path, index, "u0-7")
    p = plan(one)
    assert "(_bucket#" in p and "PartitionFilters" in p and "EqualTo(UUID,u0-7)" in p
    bucket = R.bucket_of("u0-7", 8)
    rows = R._candidates(spark, path, index, bucket)
    files = {r[0] for r in rows.select(F.input_file_name()).distinct().collect()}
    assert 1 <= len(files) <= 2 and all(f"_bucket={bucket}/" in f for f in files)


def test_incomplete_batches_and_readers_of_an_old_version(spark, store):
    path, index = store
    put(spark, path, 0, batch(0))
    R.compact(spark, path, index, buckets=4)
    old = R._candidates(spark, path, index)  # a reader that began before the next compactions
    spark.createDataFrame(batch(1), SCHEMA).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/batch_id=1")
    assert R.batches(spark, path) == [0]  # batch 1 is not complete
    for n in (2, 3):
        put(spark, path, n, batch(n))
        R.compact(spark, path, index, merge_at=3)
    assert old.count() == 60
    assert len(R.superseded(spark, index, keep=1)) == 3 and R.superseded(spark, index, keep=9) == R.superseded(spark, index, keep=2)


def test_two_compactions_at_a_time(spark, store):
    path, index = store
    put(spark, path, 0, batch(0))
    state = R.compact(spark, path, index, buckets=4)
    with pytest.raises(RuntimeError):
        R._publish(spark, index, state)  # the version is taken
    assert R._state(spark, index) == state
