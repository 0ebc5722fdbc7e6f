"""Registered stream queries. Each stages its input from the driver's tables
as topic files, runs the stream with ``availableNow`` (the whole input, then
stop), and returns a batch read of what the sink holds. Stream output must
equal the batch functions on the same rows (tests check this)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolake import schemas
from aerolake.operators import requests as rq
from aerolake.functions.labels import delay_class
from aerolake.plans.catalog import LOOKUP_UUID_EVENT, _md5_text, register, same_again, with_class_flag
from aerolake.plans.context import FLIGHT_INPUTS, ROUTE_MAX_ROWS, Tables
from aerolake.sources.materialize import materialize_path
from aerolake.session import shared_path, state_partitions
from aerolake.operators import rollups
from aerolake.sources import versions
from aerolake.streaming import correlate as corr
from aerolake.streaming import enrich, ledger
from aerolake.streaming import scoring as sc
from aerolake.streaming import silence
from aerolake.streaming.topics import as_text, publish, read_topic, topic_records

AVAILABLE_NOW = {"availableNow": True}
SENTINEL_UUID = "~end-of-input"
#: Flights before this day make the routes that the enrichment stream starts with.
ROUTES_KNOWN_TO = "1995-01-01"


REQUEST_INPUTS = ["events", "nation"]


def _request_topic(spark: SparkSession, t: Tables) -> str:
    """The request topic as published by clients: one record per event."""
    return materialize_path(spark, "topic_requests", t.paths(*REQUEST_INPUTS),
                            lambda: topic_records(t.keyed_requests, "UUID", "value", "rq_ts"))


def _message_topic(spark: SparkSession, t: Tables) -> str:
    """What the scorer consumes: enriched messages of the well-formed requests,
    and the malformed ones as their senders wrote them."""
    def build():
        good = rq.request_messages(t.enriched, keep=["Timestamp"])
        bad = t.parsed.where(F.col(f"flight.{schemas.CORRUPT_COLUMN}").isNotNull()).select(
            F.md5(F.col("event_id").cast("string")).alias("key"), F.col(f"flight.{schemas.CORRUPT_COLUMN}").alias("value"),
            F.col("ts").cast("timestamp").alias("Timestamp"))
        return topic_records(good.unionByName(bad), "key", "value", "Timestamp")
    return materialize_path(spark, "topic_all_messages", t.paths(*REQUEST_INPUTS, *FLIGHT_INPUTS), build)


def _run_to_parquet(spark: SparkSession, df: DataFrame, name: str, partitions: int | None = None) -> str:
    root = shared_path(spark, "streams", name, unique=True)
    w = (df.writeStream.format("parquet").option("checkpointLocation", f"{root}/_checkpoint")
         .outputMode("append").trigger(availableNow=True))
    if partitions:
        with state_partitions(spark, partitions):
            q = w.start(f"{root}/out")
    else:
        q = w.start(f"{root}/out")
    sc.run_to_end(q)
    return f"{root}/out"


def _ts_text(df: DataFrame) -> DataFrame:
    return df.withColumn("Timestamp", F.date_format("Timestamp", rq.TIMESTAMP_TEXT))


@register("stream_parse")
def q_stream_parse(spark, sf):
    t = Tables(spark, sf)
    topic = read_topic(spark, "parquet", _request_topic(spark, t))
    parsed = sc.parse_stream(topic)
    out = parsed.select("key", *[F.col(f"flight.{f}").alias(f) for f in
                                 ["Origin", "Dest", "Carrier", "FlightNum", "FlightDate", "DepDelay", "UUID"]],
                        F.col(f"flight.{schemas.CORRUPT_COLUMN}").isNull().alias("is_valid"))
    return spark.read.parquet(_run_to_parquet(spark, out, "stream_parse"))


def _scored_stream(spark: SparkSession, sf: str):
    t = Tables(spark, sf)
    model = t.classifier()
    topic = read_topic(spark, "parquet", _message_topic(spark, t))
    return sc.score_stream(topic, model), model


def _checked(model, rows: DataFrame) -> DataFrame:
    """Stream output with flags: its prediction is a class, and the batch score of the
    same row is the same."""
    return with_class_flag(_ts_text(same_again(model, rows)))


@register("stream_score")
def q_stream_score(spark, sf):
    scored, model = _scored_stream(spark, sf)
    return _checked(model, spark.read.schema(scored.schema).parquet(_run_to_parquet(spark, scored, "stream_score")))


@register("stream_sink_json")
def q_stream_sink_json(spark, sf):
    scored, model = _scored_stream(spark, sf)
    root = shared_path(spark, "streams", "json_sink", unique=True)
    q = sc.start_json_sink(scored, f"{root}/out", f"{root}/_checkpoint", AVAILABLE_NOW)
    sc.run_to_end(q)
    return _checked(model, spark.read.schema(scored.schema).json(f"{root}/out"))


@register("stream_sink_store")
def q_stream_sink_store(spark, sf):
    scored, model = _scored_stream(spark, sf)
    root = shared_path(spark, "streams", "store_sink", unique=True)
    q = sc.start_store_sink(scored, f"{root}/out", f"{root}/_checkpoint", AVAILABLE_NOW)
    sc.run_to_end(q)
    return _checked(model, sc.read_store(spark, f"{root}/out").drop("batch_id"))


@register("stream_fanout")
def q_stream_fanout(spark, sf):
    """The rows of all sinks of one query, each with its sink's name."""
    scored, _ = _scored_stream(spark, sf)
    root = shared_path(spark, "streams", "fanout", unique=True)
    writers = {"store": sc.store_writer(f"{root}/store"), "json": sc.json_writer(f"{root}/json"),
               "topic": sc.topic_writer("parquet", f"{root}/topic")}
    q = sc.start_fanout(scored, writers, f"{root}/_checkpoint", AVAILABLE_NOW)
    sc.run_to_end(q)
    sinks = {"store": sc.read_store(spark, f"{root}/store"), "json": spark.read.schema(scored.schema).json(f"{root}/json"),
             "topic": rq.parse_responses(spark.read.parquet(f"{root}/topic").select("key", "value"))}
    out = None
    for name, rows in sinks.items():
        own = rows.select(F.lit(name).alias("sink"), *schemas.RESPONSE_FIELDS)
        out = own if out is None else out.unionByName(own)
    return with_class_flag(_ts_text(out))


@register("stream_fanout_once")
def q_stream_fanout_once(spark, sf):
    """The rows of all sinks of one query with a ledger; its topic is appended to."""
    scored, _ = _scored_stream(spark, sf)
    root = shared_path(spark, "streams", "fanout_once", unique=True)
    sinks = {"store": sc.store_writer(f"{root}/store"), "json": sc.json_writer(f"{root}/json"),
             "topic": ledger.AppendTopic("scores", path=f"{root}/topic")}
    sc.run_to_end(ledger.start_fanout_once(scored, sinks, f"{root}/_checkpoint", AVAILABLE_NOW))
    held = {"store": spark.read.parquet(f"{root}/store"), "json": spark.read.schema(scored.schema).json(f"{root}/json"),
            "topic": rq.parse_responses(as_text(spark.read.parquet(f"{root}/topic")).select("value"))}
    out = None
    for name, rows in held.items():
        own = rows.select(F.lit(name).alias("sink"), *schemas.RESPONSE_FIELDS)
        out = own if out is None else out.unionByName(own)
    return with_class_flag(_ts_text(out))


@register("stream_enrich")
def q_stream_enrich(spark, sf):
    """Live requests with the route distance. The stream starts with the routes of the
    flights before a day; they are published anew from all flights before the second half
    of the requests (odd event ids) arrives."""
    t = Tables(spark, sf)
    root = shared_path(spark, "streams", "enrich", unique=True)
    known = [t.flights.where(F.col("FlightDate") < F.lit(ROUTES_KNOWN_TO).cast("date")), t.flights]
    for n, flights in enumerate(known):
        versions.publish(rollups.route_distance(flights, ordered=False), f"{root}/routes")
        asked = t.requests.where(F.col("event_id") % 2 == n).select(F.md5(F.col("event_id").cast("string")).alias("UUID"), F.col("ts").cast("timestamp").alias("ts"), "value")
        publish(topic_records(asked, "UUID", "value", "ts"), "parquet", f"{root}/topic")
        parsed = rq.valid_only(sc.parse_stream(read_topic(spark, "parquet", f"{root}/topic")))
        requests = parsed.select(F.col("key").alias("UUID"), "flight.Origin", "flight.Dest")
        sc.run_to_end(enrich.start_enriched(requests, f"{root}/routes", sc.store_writer(f"{root}/out"), f"{root}/_checkpoint",
                                            max_rows=ROUTE_MAX_ROWS, trigger=AVAILABLE_NOW))
    return spark.read.parquet(f"{root}/out").drop("batch_id")


def correlation_inputs(spark: SparkSession, t: Tables) -> tuple[str, str]:
    """Stored request keys and replies for the correlation stream."""
    reqs = t.keyed_requests.select("UUID", "rq_ts")
    resp = t.responses.select("UUID", F.col("rs_ts").cast("timestamp").alias("rs_ts"), "prediction")

    # A finite replay ends with one marker pair dated after all input, so the
    # watermark passes every request's limit and unmatched ones are emitted.
    def end_time():
        last = reqs.agg(F.max("rq_ts")).first()[0] or dt.datetime(1970, 1, 1)
        return last + dt.timedelta(days=1)

    def with_rq_marker():
        marker = spark.createDataFrame([(SENTINEL_UUID, end_time())], "UUID string, rq_ts timestamp")
        return reqs.unionByName(marker)

    def with_rs_marker():
        marker = spark.createDataFrame([(SENTINEL_UUID, end_time(), None)],
                                       "UUID string, rs_ts timestamp, prediction double")
        return resp.unionByName(marker)
    rq_path = materialize_path(spark, "topic_rq_keys", t.paths("events"), with_rq_marker)
    rs_path = materialize_path(spark, "topic_responses", t.paths("events"), with_rs_marker)
    return rq_path, rs_path


def correlation_stream(spark: SparkSession, t: Tables) -> DataFrame:
    rq_path, rs_path = correlation_inputs(spark, t)
    rq_stream = spark.readStream.schema("UUID string, rq_ts timestamp").parquet(rq_path)
    rs_stream = spark.readStream.schema("UUID string, rs_ts timestamp, prediction double").parquet(rs_path)
    return corr.correlate(rq_stream, rs_stream, limit_seconds=20)


@register("request_response_stream")
def q_request_response_stream(spark, sf):
    out = correlation_stream(spark, Tables(spark, sf))
    # State holds only requests and replies inside the limit plus the
    # watermark delay: a few partitions per core are plenty.
    parts = spark.sparkContext.defaultParallelism
    res = spark.read.parquet(_run_to_parquet(spark, out, "request_response", partitions=parts))
    return res.where(F.col("UUID") != SENTINEL_UUID)


@register("request_response_silence")
def q_request_response_silence(spark, sf):
    """Every request's end: its reply, or the first silence of 20 s on the reply topic."""
    rq_path, rs_path = correlation_inputs(spark, Tables(spark, sf))
    asked = spark.readStream.schema("UUID string, rq_ts timestamp").parquet(rq_path)
    said = spark.readStream.schema("UUID string, rs_ts timestamp, prediction double").parquet(rs_path)
    out = silence.await_replies(asked, said, silence_seconds=20)
    res = spark.read.schema(out.schema).parquet(_run_to_parquet(spark, out, "request_silence", partitions=spark.sparkContext.defaultParallelism))
    return res.where(F.col("UUID") != SENTINEL_UUID).select("UUID", "status", "prediction")


@register("response_lookup_stream")
def q_response_lookup_stream(spark, sf):
    """The reader side of the response topic (SRC7 + FIL8) as a stream: decode
    each record, keep the first whose JSON value carries the wanted UUID."""
    t = Tables(spark, sf)

    def build():
        scored = t.enriched.withColumn("prediction", delay_class("DepDelay"))
        msgs = rq.response_messages(scored, keep=["Timestamp"])
        return topic_records(msgs, "key", "value", "Timestamp")
    topic = materialize_path(spark, "topic_response_messages", t.paths(*REQUEST_INPUTS, *FLIGHT_INPUTS), build)
    texts = as_text(read_topic(spark, "parquet", topic)).select("key", "value")
    hit = rq.response_lookup(texts, _md5_text(LOOKUP_UUID_EVENT))
    out = spark.read.parquet(_run_to_parquet(spark, hit, "response_lookup"))
    return _ts_text(rq.parse_responses(out))
