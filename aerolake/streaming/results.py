"""Status of a request from a growing result store (JOIN3, FIL6).

The scoring stream writes a folder for each micro-batch (``batch_id=n``); a poll for
one request's result would open them all. ``compact`` folds complete batch folders
into a generation: Parquet in hash buckets of the UUID, sorted and with a Bloom filter
on it. A poll then reads one bucket of each generation, and the few batches that came
since. Once there are ``MERGE_AT`` generations they are merged into one.

Readers are safe meanwhile: a generation is written to a folder of its own, and only
then named by a new version of the index (a small text folder, created once: of two
compactions at a time one fails and leaves what it wrote unnamed). Folders that no
recent version names are listed by ``superseded`` for the cluster's housekeeping.

Results are one row per UUID, as in ``read_store``: the earliest generation's, then the
lowest batch's. Rows without a UUID can't be polled; they stay in the generations.
"""

from __future__ import annotations

import json
import uuid as ids
import zlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolake.functions.labels import STATUS_WAIT, status_column
from aerolake.sources.materialize import _store

BUCKETS = 256
MERGE_AT = 8
KEY, BUCKET, AGE = "UUID", "_bucket", "_age"


def bucket_of(uuid: str, buckets: int) -> int:
    return zlib.crc32(uuid.encode()) % buckets


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    p, store = _store(spark, path)
    return [s.getPath().getName() for s in store.listStatus(p) if s.isDirectory()] if store.exists(p) else []


def _complete(spark: SparkSession, path: str) -> bool:
    p, store = _store(spark, f"{path}/_SUCCESS")
    return store.exists(p)


def versions(spark: SparkSession, index: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in _names(spark, f"{index}/versions") if _complete(spark, f"{index}/versions/{n}"))


def _state(spark: SparkSession, index: str, version: int | None = None) -> dict:
    """What a version (the last one) of the index names: generations, oldest first, and
    batches folded into them."""
    known = versions(spark, index)
    if not known:
        return {"version": 0, "generations": [], "folded": [], "buckets": None}
    version = known[-1] if version is None else version
    return json.loads(spark.read.text(f"{index}/versions/v={version}").first()["value"])


def batches(spark: SparkSession, store: str) -> list[int]:
    """Complete batch folders of the store."""
    found = [int(n.split("=")[1]) for n in _names(spark, store) if n.startswith("batch_id=")]
    return sorted(b for b in found if _complete(spark, f"{store}/batch_id={b}"))


def _publish(spark: SparkSession, index: str, state: dict) -> None:
    try:
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.text(f"{index}/versions/v={state['version']}")
    except AnalysisException as e:
        raise RuntimeError("another compaction published first; run it again") from e


def _read_batches(spark: SparkSession, store: str, numbers: list[int], schema) -> DataFrame:
    rows = spark.read.schema(schema).option("basePath", store).parquet(*[f"{store}/batch_id={b}" for b in numbers])
    return rows.withColumnRenamed("batch_id", AGE)


def _read_generations(spark: SparkSession, index: str, generations: list[str], schema) -> DataFrame:
    """The rows of the generations with their age: 0 for the oldest."""
    out = None
    for age, name in enumerate(generations):
        rows = spark.read.schema(schema).parquet(f"{index}/{name}").withColumn(AGE, F.lit(age))
        out = rows if out is None else out.unionByName(rows)
    return out


def _earliest(rows: DataFrame) -> DataFrame:
    """One row per UUID, the oldest; all rows without one."""
    columns = [c for c in rows.columns if c not in (KEY, AGE)]
    first = rows.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.min_by(F.struct(*columns), AGE).alias("_r"))
    return first.select(KEY, *[F.col(f"_r.{c}").alias(c) for c in columns]).unionByName(rows.where(F.col(KEY).isNull()).drop(AGE))


def _schemas(spark: SparkSession, store: str, known: list[int]):
    """(columns of the results, the same with the batch number)."""
    plain = spark.read.parquet(f"{store}/batch_id={known[0]}").schema
    return plain, type(plain)([*plain.fields, *spark.createDataFrame([], "batch_id int").schema.fields])


def _write(rows: DataFrame, path: str, buckets: int) -> None:
    bucket = F.coalesce(F.crc32(F.col(KEY).cast("binary")) % buckets, F.lit(0)).cast("int")
    # (bucket, UUID) ranges: a file holds few buckets, and no bucket must fit into one task
    keyed = rows.withColumn(BUCKET, bucket).repartitionByRange(BUCKET, KEY).sortWithinPartitions(BUCKET, KEY)
    keyed.write.option(f"parquet.bloom.filter.enabled#{KEY}", "true").partitionBy(BUCKET).parquet(path)


def compact(spark: SparkSession, store: str, index: str, buckets: int = BUCKETS, merge_at: int = MERGE_AT) -> dict:
    """Fold the store's new batches into a generation and publish it; merge the
    generations when there are ``merge_at``. Returns what the index now names."""
    state = _state(spark, index)
    known = batches(spark, store)
    new = [b for b in known if b not in set(state["folded"])]
    if not new:
        return state
    plain, numbered = _schemas(spark, store, known)
    buckets = state["buckets"] or buckets
    name = f"generation-{ids.uuid4().hex}"
    _write(_earliest(_read_batches(spark, store, new, numbered)), f"{index}/{name}", buckets)
    state = {"version": state["version"] + 1, "generations": [*state["generations"], name], "folded": sorted([*state["folded"], *new]), "buckets": buckets}
    if len(state["generations"]) >= merge_at:
        merged = f"generation-{ids.uuid4().hex}"
        _write(_earliest(_read_generations(spark, index, state["generations"], plain)), f"{index}/{merged}", buckets)
        state["generations"] = [merged]
    _publish(spark, index, state)
    return state


def superseded(spark: SparkSession, index: str, keep: int = 2) -> list[str]:
    """Generation folders that none of the last ``keep`` versions names."""
    recent = versions(spark, index)[-keep:]
    named = {g for v in recent for g in _state(spark, index, v)["generations"]}
    return sorted(n for n in _names(spark, index) if n.startswith("generation-") and n not in named)


def _candidates(spark: SparkSession, store: str, index: str, bucket: int | None = None) -> DataFrame | None:
    """Rows that a poll may have to read, generations before batches (``bucket``: those of one bucket)."""
    state = _state(spark, index)
    known = batches(spark, store)
    if not known:
        return None
    plain, numbered = _schemas(spark, store, known)
    out = None
    if state["generations"]:
        kept = type(plain)([*plain.fields, *spark.createDataFrame([], f"{BUCKET} int").schema.fields])
        out = _read_generations(spark, index, state["generations"], kept)
        out = (out if bucket is None else out.where(F.col(BUCKET) == bucket)).drop(BUCKET)
    fresh = [b for b in known if b not in set(state["folded"])]
    if fresh:
        rows = _read_batches(spark, store, fresh, numbered).withColumn(AGE, F.col(AGE) + len(state["generations"]))
        out = rows if out is None else out.unionByName(rows)
    return out


def poll(spark: SparkSession, store: str, index: str, uuid: str) -> DataFrame:
    """One row: UUID, status (OK or WAIT), and the result's columns (null while waiting)."""
    asked = spark.createDataFrame([(uuid,)], f"{KEY} string")
    state = _state(spark, index)
    rows = _candidates(spark, store, index, bucket_of(uuid, state["buckets"]) if state["buckets"] else None)
    if rows is None:
        return asked.withColumn("status", F.lit(STATUS_WAIT))
    first = rows.where(F.col(KEY) == F.lit(uuid)).orderBy(AGE).limit(1).drop(AGE)
    return _status(asked, first)


def poll_many(spark: SparkSession, store: str, index: str, requests: DataFrame) -> DataFrame:
    """The status of every request in ``requests`` (UUID): one join."""
    rows = _candidates(spark, store, index)
    if rows is None:
        return requests.select(KEY).withColumn("status", F.lit(STATUS_WAIT))
    return _status(requests.select(KEY), _earliest(rows.where(F.col(KEY).isNotNull())))


def _status(requests: DataFrame, results: DataFrame) -> DataFrame:
    found = results.withColumn("_found", F.lit(True))
    joined = requests.join(found, KEY, "left")
    return joined.select(KEY, status_column(F.col("_found").isNotNull(), STATUS_WAIT).alias("status"), *[c for c in results.columns if c != KEY])
