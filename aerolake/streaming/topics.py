"""Message-topic sources and the file stand-in used when no broker is present
(SRC4, SRC7, SNK8).

A topic record is (key BINARY, value BINARY, timestamp TIMESTAMP), the shape
Spark's Kafka source gives. ``read_topic`` takes the format and options as
parameters, so the same job reads ``format("kafka")`` on a cluster and a
folder of Parquet topic records in tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerolake import schemas


def topic_records(df: DataFrame, key: Column | str, value: Column | str,
                  timestamp: Column | str | None = None) -> DataFrame:
    """Rows -> topic records (key/value bytes, event time)."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    ts = c(timestamp) if timestamp is not None else F.current_timestamp()
    return df.select(c(key).cast("binary").alias("key"), c(value).cast("binary").alias("value"),
                     ts.cast("timestamp").alias("timestamp"))


def publish(records: DataFrame, fmt: str = "parquet", path: str | None = None,
            options: dict[str, str] | None = None, mode: str = "append") -> None:
    """Batch publish of topic records (SNK8): ``format("kafka")`` with a
    ``topic`` option on a cluster, or an append to a topic folder."""
    if fmt == "kafka":
        records.select("key", "value").write.format(fmt).options(**(options or {})).save()
        return
    records.write.format(fmt).options(**(options or {})).mode(mode).save(path)


def read_topic(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
               options: dict[str, str] | None = None) -> DataFrame:
    """Streaming read of a topic (SRC4/SRC7). For Kafka pass ``subscribe``
    and ``startingOffsets`` (Spark's default is ``latest``), and
    ``maxOffsetsPerTrigger``/``minPartitions`` to size micro-batches; file
    stand-ins take ``maxFilesPerTrigger``."""
    r = spark.readStream.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        r = r.schema(schemas.TOPIC)
    return r.load(path) if path else r.load()


def as_text(topic: DataFrame) -> DataFrame:
    """Key and value bytes -> text (SCA1), event time kept."""
    return topic.select(F.col("key").cast("string").alias("key"),
                        F.col("value").cast("string").alias("value"), "timestamp")
