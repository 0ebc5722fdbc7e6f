"""Exactly-once fan-out: what each sink holds is written down batch by batch (SNK3, SNK6).

A micro-batch that failed is run again under the same number. The ledger in the shared
folder then tells, for each sink, whether it has the batch (``done``: it is skipped),
never got it (it is written), or was interrupted in between (``begun``). Folder sinks
replace the folder of their batch, so an interrupted one is written again. A topic can
only be appended to: its records carry the batch's name in a header, those of this batch
that arrived since it was begun are read back, and only the missing ones are sent. They
are compared as a multiset, so equal records are told apart by their number.

One query writes to a ledger, as one query writes to a checkpoint. Notes are files of a few
bytes, renamed into place; those of batches that can't be run again are deleted.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolake.operators import requests as rq
from aerolake.sources.materialize import _store
from aerolake.streaming.scoring import BatchWriter, _write_from_cache, _writer

HEADER = "batch"
#: Clocks of writers and readers of a topic may differ by this much.
CLOCK_SLACK = dt.timedelta(hours=1)


@dataclass
class Ledger:
    """Notes (topic of the note, batch id) -> text under ``path``. Spark runs again only
    the last batch; notes of the ``keep`` batches before it stay for readers."""

    spark: SparkSession
    path: str
    keep: int = 100

    def _file(self, what: str, batch_id: int) -> str:
        return f"{self.path.rstrip('/')}/{what}/{batch_id}"

    def get(self, what: str, batch_id: int) -> str | None:
        name = self._file(what, batch_id)
        path, store = _store(self.spark, name)
        if not store.exists(path):
            return None
        return "\n".join(r["value"] for r in self.spark.read.text(name).collect())

    def put(self, what: str, batch_id: int, text: str) -> str:
        """Write a note once; a note that is there already stays, and is returned."""
        name = self._file(what, batch_id)
        path, store = _store(self.spark, name)
        if store.exists(path):
            return self.get(what, batch_id)
        draft, _ = _store(self.spark, f"{self.path.rstrip('/')}/{what}/_draft-{batch_id}")
        out = store.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not store.rename(draft, path):
            raise OSError(f"note {name} could not be written")
        store.delete(_store(self.spark, self._file(what, batch_id - self.keep))[0], False)
        return text


@dataclass
class AppendTopic:
    """A response topic that can only be appended to. ``name`` tells this stream's records
    from others' in the same topic. With Kafka give the topic in both kinds of options
    (``topic`` to write, ``subscribe`` to read)."""

    name: str
    fmt: str = "parquet"
    path: str | None = None
    write_options: dict[str, str] = field(default_factory=dict)
    read_options: dict[str, str] = field(default_factory=dict)

    def messages(self, scored: DataFrame, batch_id: int) -> DataFrame:
        tag = F.struct(F.lit(HEADER).alias("key"), F.lit(f"{self.name}/{batch_id}").cast("binary").alias("value"))
        return rq.response_messages(scored).select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                                                   F.array(tag).alias("headers"))

    def send(self, messages: DataFrame) -> None:
        if self.fmt == "kafka":
            messages.write.format("kafka").options(**self.write_options).save()
        else:
            (messages.withColumn("timestamp", F.current_timestamp()).write.format(self.fmt)
             .options(**self.write_options).mode("append").save(self.path))

    def missing(self, messages: DataFrame, batch_id: int, since: dt.datetime) -> DataFrame:
        """Messages of the batch that the topic has not got, looking at what arrived since."""
        spark = messages.sparkSession
        since = since - CLOCK_SLACK
        if self.fmt == "kafka":
            rows = spark.read.format("kafka").options(includeHeaders="true", **self.read_options).option(
                "startingTimestamp", str(int(since.timestamp() * 1000))).load()
        else:
            folder, store = _store(spark, self.path)
            if not store.exists(folder):
                return messages
            schema = "key binary, value binary, timestamp timestamp, headers array<struct<key: string, value: binary>>"
            rows = spark.read.format(self.fmt).schema(schema).options(**self.read_options).load(self.path).where(
                F.col("timestamp") >= F.lit(since))
        tag = f"{self.name}/{batch_id}"
        mine = F.exists("headers", lambda h: (h["key"] == HEADER) & (h["value"].cast("string") == tag))
        return messages.exceptAll(rows.where(mine).select("key", "value", "headers"))


Sink = BatchWriter | AppendTopic


def once(ledger: Ledger, name: str, sink: Sink) -> BatchWriter:
    """The sink's writer, guarded by the ledger: however often a batch is run, its rows are
    there once. A plain writer must replace what an interrupted run of the batch left."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if ledger.get(f"{name}.done", batch_id) is not None:
            return
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        begun = ledger.get(f"{name}.begun", batch_id)
        if begun is None:
            ledger.put(f"{name}.begun", batch_id, now)
        if isinstance(sink, AppendTopic):
            messages = sink.messages(batch, batch_id)
            sink.send(messages if begun is None else sink.missing(messages, batch_id, dt.datetime.fromisoformat(begun)))
        else:
            sink(batch, batch_id)
        ledger.put(f"{name}.done", batch_id, now)
    return write


def start_fanout_once(df: DataFrame, sinks: dict[str, Sink], checkpoint_root: str,
                      trigger: dict | None = None, name: str = "fanout_once") -> StreamingQuery:
    """One query, scored once per micro-batch, every sink exactly once. The ledger lies
    beside the query's checkpoint; delete or move both or neither."""
    ledger = Ledger(df.sparkSession, f"{checkpoint_root.rstrip('/')}/{name}_ledger")
    writers = {n: once(ledger, n, s) for n, s in sinks.items()}

    def write_all(batch: DataFrame, batch_id: int) -> None:
        _write_from_cache(batch, writers, batch_id)
    return _writer(df, name, checkpoint_root, trigger).foreachBatch(write_all).start()
