"""The scoring stream and its sinks (STR1-3, SNK2-6).

parse -> flatten -> route -> index/assemble/forest, all per-row, so a
micro-batch never shuffles. Sinks:

* JSON files (SNK4): Spark's file sink, exactly once through its log.
* store (SNK2): ``foreachBatch`` that overwrites the folder ``batch_id=<n>``;
  a replayed batch rewrites the same folder, so nothing is duplicated.
* topic (SNK3): key = UUID, value = JSON; at least once, readers drop
  duplicates on UUID.
* console (SNK5): debug only.

``start_fanout`` runs ONE query that parses and scores each micro-batch once,
persists it and writes every sink from it; ``start_separate`` runs one query
per sink, as the reference does (each re-reads and re-scores the input).
"""

from __future__ import annotations

from typing import Callable

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolake import schemas
from aerolake.operators import ml
from aerolake.operators import requests as rq
from aerolake.operators.joins import broadcast_if_bounded
from aerolake.functions.messages import JSON_OPTIONS
from aerolake.session import checkpoint_root
from aerolake.streaming.topics import as_text

BatchWriter = Callable[[DataFrame, int], None]
#: Keys that a store holds more than once, up to which they are broadcast: some 50 MB.
REPEATED_MAX_KEYS = 500_000


def parse_stream(topic: DataFrame) -> DataFrame:
    """Topic records -> parsed request struct, with key and topic time."""
    return rq.parse_requests(as_text(topic), keep=["key", "timestamp"])


def score_stream(topic: DataFrame, model: PipelineModel, drop_corrupt: bool = False) -> DataFrame:
    """Request records -> scored rows: the request fields plus ``prediction``.

    By default a malformed message is scored as a row of nulls, as the
    reference does; with ``drop_corrupt`` only well-formed messages are scored
    (route the others with ``corrupt_records`` to a quarantine sink)."""
    parsed = parse_stream(topic)
    if drop_corrupt:
        parsed = rq.valid_only(parsed)
    return ml.score(model, rq.flatten(parsed, keep=[]))


def corrupt_records(topic: DataFrame) -> DataFrame:
    """Malformed request messages (key, topic time, raw text) for quarantine."""
    parsed = parse_stream(topic)
    bad = parsed.where(F.col(f"flight.{schemas.CORRUPT_COLUMN}").isNotNull())
    return bad.select("key", "timestamp", F.col(f"flight.{schemas.CORRUPT_COLUMN}").alias("raw"))


def start_scoring_with_quarantine(topic: DataFrame, model: PipelineModel, writers: dict[str, BatchWriter],
                                  quarantine: BatchWriter, checkpoint_root: str,
                                  trigger: dict | None = None, name: str = "fanout_q") -> StreamingQuery:
    """One query: each micro-batch is parsed once; malformed messages go to
    ``quarantine``, the rest are scored once and written to every sink."""
    def write_all(batch: DataFrame, batch_id: int) -> None:
        parsed = rq.parse_requests(as_text(batch), keep=["key", "timestamp"])
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            bad = parsed.where(F.col(f"flight.{schemas.CORRUPT_COLUMN}").isNotNull())
            quarantine(bad.select("key", "timestamp", F.col(f"flight.{schemas.CORRUPT_COLUMN}").alias("raw")),
                       batch_id)
            _write_from_cache(ml.score(model, rq.flatten(rq.valid_only(parsed), keep=[])), writers, batch_id)
        finally:
            parsed.unpersist()
    return _writer(topic, name, checkpoint_root, trigger).foreachBatch(write_all).start()


def _write_from_cache(batch: DataFrame, writers: dict[str, BatchWriter], batch_id: int) -> None:
    """Persist ``batch``; the first writer fills the cache, the others then
    write from it as concurrent Spark jobs."""
    from concurrent.futures import ThreadPoolExecutor

    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first, *rest = list(writers.values())
        first(batch, batch_id)
        if rest:
            with ThreadPoolExecutor(max_workers=len(rest)) as pool:
                for f in [pool.submit(w, batch, batch_id) for w in rest]:
                    f.result()
    finally:
        batch.unpersist()


def _writer(df: DataFrame, name: str, checkpoint_root: str, trigger: dict | None):
    w = df.writeStream.queryName(name).option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{name}")
    return w.trigger(**trigger) if trigger else w


def start_json_sink(df: DataFrame, path: str, checkpoint_root: str, trigger: dict | None = None,
                    name: str = "json_sink") -> StreamingQuery:
    """Append JSON files (SNK4)."""
    return (_writer(df, name, checkpoint_root, trigger).format("json").options(**JSON_OPTIONS)
            .outputMode("append").start(path))


def store_writer(path: str, fmt: str = "parquet") -> BatchWriter:
    """Batch writer that replaces the folder of its own batch id (SNK2)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write


def format_writer(fmt: str, options: dict[str, str] | None = None) -> BatchWriter:
    """Batch writer that appends to an external store named by its format
    (e.g. a document-store connector); at least once on replay, so readers
    drop duplicates on UUID."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).options(**(options or {})).mode("append").save()
    return write


def json_writer(path: str) -> BatchWriter:
    """Batch writer of JSON files per batch id (time stamps keep microseconds)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").options(**JSON_OPTIONS).json(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write


def topic_writer(fmt: str = "parquet", path: str | None = None,
                 options: dict[str, str] | None = None) -> BatchWriter:
    """Batch writer of response records (key = UUID, value = JSON) (SNK3)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = rq.response_messages(batch).write.format(fmt).options(**(options or {}))
        if fmt == "kafka":
            out.save()
        else:
            out.mode("overwrite").save(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write


def start_store_sink(df: DataFrame, path: str, checkpoint_root: str, trigger: dict | None = None,
                     name: str = "store_sink") -> StreamingQuery:
    return _writer(df, name, checkpoint_root, trigger).foreachBatch(store_writer(path)).start()


def start_topic_sink(df: DataFrame, checkpoint_root: str, fmt: str = "kafka", path: str | None = None,
                     options: dict[str, str] | None = None, trigger: dict | None = None,
                     name: str = "topic_sink") -> StreamingQuery:
    """Response records to a topic (SNK3): ``format("kafka")`` + ``topic`` option."""
    msgs = rq.response_messages(df)
    w = _writer(msgs, name, checkpoint_root, trigger).format(fmt).options(**(options or {})).outputMode("append")
    return w.start(path) if path else w.start()


def start_console_sink(df: DataFrame, trigger: dict | None = None) -> StreamingQuery:
    """Debug output (SNK5); no checkpoint, as in the reference."""
    w = df.writeStream.format("console").outputMode("append")
    return (w.trigger(**trigger) if trigger else w).start()


def start_fanout(df: DataFrame, writers: dict[str, BatchWriter], checkpoint_root: str,
                 trigger: dict | None = None, name: str = "fanout") -> StreamingQuery:
    """One query, scored once per micro-batch, written to every sink (SNK6).

    The first sink's write fills the cache of the scored batch; the other
    sinks then write from the cache as concurrent Spark jobs."""
    def write_all(batch: DataFrame, batch_id: int) -> None:
        _write_from_cache(batch, writers, batch_id)
    return _writer(df, name, checkpoint_root, trigger).foreachBatch(write_all).start()


def start_separate(df: DataFrame, writers: dict[str, BatchWriter], checkpoint_root: str,
                   trigger: dict | None = None) -> list[StreamingQuery]:
    """One query per sink (SNK6 as the reference runs it)."""
    return [_writer(df, f"sink_{n}", checkpoint_root, trigger).foreachBatch(w).start()
            for n, w in writers.items()]


def await_any(spark: SparkSession, timeout: float | None = None) -> None:
    """Block until any query ends (STR3). If it ended with an error, that
    error is raised here (``awaitAnyTermination`` re-raises it), so a failing
    sink stops the application instead of going unseen."""
    if timeout is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(int(timeout))


def read_store(spark: SparkSession, path: str, schema=None, fmt: str = "parquet",
               key: str = "UUID", key_value: str | None = None) -> DataFrame:
    """Read a store sink, one row per key (replays are already idempotent;
    this also drops at-least-once duplicates). Rows without a key can't be
    duplicates of each other and all stay. ``key_value`` reads one key: its
    filter reaches the scan, so only its few rows are shuffled. Otherwise the
    keys are counted first (a job that moves nothing but keys), and only the
    rows of keys that stand there more than once are compared; the others are
    read as they are."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    if key not in df.columns:
        return df
    if key_value is not None:
        return df.where(F.col(key) == F.lit(key_value)).dropDuplicates([key])
    checkpoint_root(spark)  # make sure a (shared) checkpoint folder is set
    counted = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_again")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = broadcast_if_bounded(counted.where("_n > 1").select("_again").checkpoint(eager=True), REPEATED_MAX_KEYS)
    same = F.col(key) == F.col("_again")
    return df.join(repeated, same, "left_anti").unionByName(df.join(repeated, same, "left_semi").dropDuplicates([key]))


def run_to_end(queries: list[StreamingQuery] | StreamingQuery) -> None:
    """Wait for ``availableNow`` queries; raise if one failed."""
    for q in (queries if isinstance(queries, list) else [queries]):
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream {q.name} failed: {q.exception()}")
