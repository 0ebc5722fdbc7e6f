import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerolake.operators import ml
from aerolake.operators import requests as rq
from aerolake.plans import streams as S
from aerolake.plans.context import Tables
from aerolake.session import shared_path
from aerolake.streaming import correlate as corr
from aerolake.streaming import scoring as sc
from aerolake.streaming.topics import publish, read_topic, topic_records
from conftest import SF_MID, SF_SMALL

NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def setup(spark):
    t = Tables(spark, SF_SMALL)
    model = ml.train_classifier(ml.training_frame(t.flights), num_trees=5)
    recs = topic_records(rq.request_messages(t.enriched, keep=["Timestamp"]), "key", "value", "Timestamp")
    topic = shared_path(spark, "test_topic", unique=True)
    # two files -> two micro-batches with maxFilesPerTrigger=1
    publish(recs.where(F.col("key") < "8"), "parquet", topic)
    publish(recs.where(F.col("key") >= "8"), "parquet", topic)
    return t, model, topic


def _stream(spark, topic, model):
    return sc.score_stream(read_topic(spark, "parquet", topic, {"maxFilesPerTrigger": "1"}), model)


def test_stream_equals_batch(spark, setup):
    t, model, topic = setup
    root = shared_path(spark, "test_stream", unique=True)
    q = (_stream(spark, topic, model).writeStream.format("parquet").trigger(availableNow=True)
         .option("checkpointLocation", root + "/ck").start(root + "/out"))
    sc.run_to_end(q)
    got = {(r.UUID, r.prediction) for r in spark.read.parquet(root + "/out").collect()}
    want = {(r.UUID, r.prediction) for r in ml.score(model, t.enriched).collect()}
    assert got == want and len(got) == t.enriched.count()


def test_restart_adds_nothing(spark, setup):
    t, model, topic = setup
    root = shared_path(spark, "test_restart", unique=True)
    for _ in range(2):
        q = sc.start_json_sink(_stream(spark, topic, model), root + "/out", root + "/ck", NOW)
        sc.run_to_end(q)
    df = spark.read.json(root + "/out")
    assert df.count() == t.enriched.count()
    assert df.select("UUID").distinct().count() == df.count()


def test_store_sink_replay_idempotent(spark, setup):
    t, model, _ = setup
    root = shared_path(spark, "test_store", unique=True)
    w = sc.store_writer(root)
    batch = ml.score(model, t.enriched)
    w(batch, 0)
    w(batch, 0)  # replay of the same batch id
    assert spark.read.parquet(root).count() == batch.count()


def test_fanout_equals_separate(spark, setup):
    t, model, topic = setup
    root = shared_path(spark, "test_fanout", unique=True)
    writers = lambda base: {"store": sc.store_writer(base + "/store"),
                            "topic": sc.topic_writer("parquet", base + "/topic")}
    sc.run_to_end(sc.start_fanout(_stream(spark, topic, model), writers(root + "/one"), root + "/ck1", NOW))
    sc.run_to_end(sc.start_separate(_stream(spark, topic, model), writers(root + "/many"), root + "/ck2", NOW))
    for sink in ["store", "topic"]:
        a = spark.read.parquet(f"{root}/one/{sink}").drop("batch_id")
        b = spark.read.parquet(f"{root}/many/{sink}").drop("batch_id")
        assert a.count() == b.count() == t.enriched.count()
        assert a.exceptAll(b).count() == 0
    msgs = rq.parse_responses(spark.read.parquet(f"{root}/one/topic"))
    assert msgs.where(F.col("key") != F.col("UUID")).count() == 0


def test_failed_query_raises(spark, setup):
    t, model, topic = setup
    root = shared_path(spark, "test_fail", unique=True)

    def boom(df, batch_id):
        raise ValueError("sink down")
    q = _stream(spark, topic, model).writeStream.foreachBatch(boom).trigger(availableNow=True) \
        .option("checkpointLocation", root).start()
    with pytest.raises(Exception):
        sc.run_to_end(q)


def test_request_response_counts_sf001(spark):
    df = S.q_request_response_stream(spark, SF_MID)
    assert df.count() == 10_000 == df.select("UUID").distinct().count()
    assert df.where("status = 'OK'").count() == 7714


def _correlated(spark, requests, responses, per_batch=False):
    """Run the stream; per_batch gives each reply a micro-batch of its own."""
    root = shared_path(spark, "test_corr", unique=True)
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    at = lambda n: t0 + dt.timedelta(seconds=n)
    rq_rows = [(u, at(n)) for u, n in requests]
    rs_rows = [(u, at(n), p) for u, n, p in responses]
    groups = [[r] for r in rs_rows] if per_batch else [rs_rows]
    for i, rows in enumerate(groups):
        spark.createDataFrame(rows, "UUID string, rs_ts timestamp, prediction double").coalesce(1).write.mode("append").parquet(root + "/rs")
        more = rq_rows if i == 0 else [("tick%d" % i, rows[0][1])]
        spark.createDataFrame(more, "UUID string, rq_ts timestamp").coalesce(1).write.mode("append").parquet(root + "/rq")
    opt = {"maxFilesPerTrigger": "1"} if per_batch else {}
    a = spark.readStream.schema("UUID string, rq_ts timestamp").options(**opt).parquet(root + "/rq")
    b = spark.readStream.schema("UUID string, rs_ts timestamp, prediction double").options(**opt).parquet(root + "/rs")
    q = (corr.correlate(a, b).writeStream.format("parquet").trigger(availableNow=True)
         .option("checkpointLocation", root + "/ck").start(root + "/out"))
    sc.run_to_end(q)
    rows = [(r.UUID, r.status, r.prediction) for r in spark.read.parquet(root + "/out").collect()]
    return sorted((r for r in rows if not r[0].startswith(("tick", "end"))), key=str)


def test_correlate_window_and_duplicates(spark):
    got = _correlated(spark, [("a", 0), ("b", 0), ("c", 0), ("end", 3600)],
                      [("a", 2, 1.0), ("a", 3, 1.0), ("b", 30, 2.0), ("end", 3600, 0.0)])
    assert got == [("a", "OK", 1.0), ("b", "TIMEOUT", None), ("c", "TIMEOUT", None)]


def test_correlate_gives_one_row_and_the_earliest_reply_inside(spark):
    got = _correlated(spark, [("a", 0), ("b", 0), ("c", 0), ("d", 0), ("end", 3600)],
                      [("a", 2, 1.0), ("a", 15, 3.0), ("b", 30, 2.0), ("b", 2, 0.0), ("c", -3, 3.0), ("c", 2, 1.0),
                       ("d", 5, None), ("end", 3600, 0.0)])
    assert got == [("a", "OK", 1.0), ("b", "OK", 0.0), ("c", "OK", 1.0), ("d", "OK", None)]


def test_correlate_over_several_batches(spark):
    got = _correlated(spark, [("a", 0), ("b", 0)],
                      [("a", 2, 1.0), ("b", 4, 2.0), ("x", 8, 0.0), ("a", 15, 3.0), ("x", 40, 0.0), ("x", 90, 0.0), ("end", 3600, 0.0), ("end", 7200, 0.0)], per_batch=True)
    assert got == [("a", "OK", 1.0), ("b", "OK", 2.0)]


def test_read_store_keeps_rows_without_key(spark):
    root = shared_path(spark, "test_nullkeys", unique=True)
    rows = [(None, 1.0), (None, 2.0), ("u", 1.0), ("u", 1.0), ("v", 0.0)]
    spark.createDataFrame(rows, "UUID string, prediction double").write.parquet(root)
    got = sorted(map(tuple, sc.read_store(spark, root).collect()), key=str)
    assert got == sorted([(None, 1.0), (None, 2.0), ("u", 1.0), ("v", 0.0)], key=str)
    assert [tuple(r) for r in sc.read_store(spark, root, key_value="u").collect()] == [("u", 1.0)]


def test_console_and_format_writer(spark, setup, capsys):
    t, model, topic = setup
    root = shared_path(spark, "test_console", unique=True)
    q = sc.start_console_sink(_stream(spark, topic, model).select("UUID", "prediction"), NOW)
    sc.run_to_end(q)
    w = sc.format_writer("parquet", {"path": root + "/ext"})
    batch = ml.score(model, t.enriched)
    w(batch, 0)
    assert spark.read.parquet(root + "/ext").count() == batch.count()


def test_await_any_returns_when_a_query_ends(spark, setup):
    t, model, topic = setup
    root = shared_path(spark, "test_await", unique=True)
    spark.streams.resetTerminated()  # forget queries ended by earlier tests
    q = sc.start_store_sink(_stream(spark, topic, model), root + "/out", root + "/ck", NOW)
    sc.await_any(spark, timeout=120)
    q.awaitTermination()
    spark.streams.resetTerminated()
    assert sc.read_store(spark, root + "/out").count() == t.enriched.count()


def test_quarantine_malformed_messages(spark, setup):
    t, model, _ = setup
    root = shared_path(spark, "test_quarantine", unique=True)
    raw = t.keyed_requests
    publish(topic_records(raw, "UUID", "value", "rq_ts"), "parquet", root + "/topic")
    topic = read_topic(spark, "parquet", root + "/topic")
    q = sc.start_scoring_with_quarantine(topic, model, {"store": sc.store_writer(root + "/scored")},
                                         sc.store_writer(root + "/quarantine"), root + "/ck", NOW)
    sc.run_to_end(q)
    n_bad = t.parsed.where(F.col("flight._corrupt_record").isNotNull()).count()
    scored = spark.read.parquet(root + "/scored")
    bad = spark.read.parquet(root + "/quarantine")
    assert bad.count() == n_bad > 0
    assert scored.count() == raw.count() - n_bad
    assert bad.where(F.col("raw").endswith("}")).count() == 0  # truncated messages only
    # the plain stream keeps the reference's behaviour: every message scored
    plain = sc.score_stream(spark.read.parquet(root + "/topic"), model)
    assert plain.count() == raw.count()
    assert sc.score_stream(spark.read.parquet(root + "/topic"), model, drop_corrupt=True).count() == raw.count() - n_bad
    assert sc.corrupt_records(spark.read.parquet(root + "/topic")).count() == n_bad


def test_scoring_stream_has_no_shuffle(spark, setup):
    import contextlib
    import io
    t, model, topic = setup
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        _stream(spark, topic, model).explain()
    plan = buf.getvalue()
    assert "Exchange" not in plan and "BatchEvalPython" not in plan


def test_await_any_raises_failure(spark, setup):
    t, model, topic = setup
    root = shared_path(spark, "test_await_fail", unique=True)
    spark.streams.resetTerminated()

    def boom(df, batch_id):
        raise ValueError("store down")
    _stream(spark, topic, model).writeStream.foreachBatch(boom).trigger(availableNow=True) \
        .option("checkpointLocation", root).start()
    with pytest.raises(Exception):
        sc.await_any(spark, timeout=120)
    spark.streams.resetTerminated()


def test_correlation_restart_adds_nothing(spark):
    from aerolake.plans.streams import SENTINEL_UUID, correlation_stream
    t = Tables(spark, SF_SMALL)
    root = shared_path(spark, "test_corr_restart", unique=True)
    counts = []
    for _ in range(2):
        q = (correlation_stream(spark, t).writeStream.format("parquet").trigger(availableNow=True)
             .option("checkpointLocation", root + "/ck").start(root + "/out"))
        sc.run_to_end(q)
        counts.append(spark.read.parquet(root + "/out").count())
    n = t.table("events").count()
    assert counts[0] == counts[1] == n  # every request once; the end marker's limit has not passed
    out = spark.read.parquet(root + "/out").where(F.col("UUID") != SENTINEL_UUID)
    assert out.select("UUID").distinct().count() == n
