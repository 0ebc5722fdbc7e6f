"""Derived tables and model artifacts kept in the shared folder.

A derived table (the flight fact table built from the driver's tables) is
written once per *input fingerprint* and read by every later query: this cuts
lineage (a lost executor re-reads files instead of re-running the joins) and
lets Parquet statistics prune row groups. The fingerprint holds the input
files' paths, sizes and modification times and is taken anew on each use, so
changed inputs give a new table and a stale one is never read.

Each build writes a folder of its own; a pointer then names the build to read.
Two applications may build at the same time: neither touches the other's files,
and all readers follow the pointer that was published first.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from aerolake.session import shared_path


# Version of the derivations: part of every stored artifact's name, so a
# change to how a table, topic or model is derived never reuses an old build.
ARTIFACT_VERSION = "4"


def _artifact(spark: SparkSession, kind: str, name: str, inputs: list[str]) -> str:
    return shared_path(spark, kind, f"{name}-v{ARTIFACT_VERSION}-{fingerprint(spark, inputs)}")


def _store(spark: SparkSession, path: str):
    """(path, its file system), as Spark resolves them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Hash of the paths, sizes and modification times of all files under ``paths``.
    Single files are asked for by their status; folders are listed by Spark (one
    small aggregation, file contents unread)."""
    texts, folders = [], []
    for path in paths:
        p, store = _store(spark, path)
        status = store.getFileStatus(p)
        if status.isDirectory():
            folders.append(path)
        else:
            texts.append(f"{path}|{status.getLen()}|{status.getModificationTime()}")
    if folders:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
        row = files.agg(F.count(F.lit(1)), F.sum("length"),
                        F.expr("bit_xor(xxhash64(path, length, modificationTime))")).first()
        texts.append("|".join(map(str, row)))
    return hashlib.sha1("\n".join(texts).encode()).hexdigest()[:16]


def _published(spark: SparkSession, path: str) -> str | None:
    """The build that the pointer names, if one is complete."""
    success, store = _store(spark, f"{path}/current/_SUCCESS")
    if not store.exists(success):
        return None
    names = [r["value"] for r in spark.read.text(f"{path}/current").collect()]
    return f"{path}/{min(names)}" if names else None


#: Builds found complete: a build never changes once its pointer is published.
_builds: dict[str, str] = {}
_locks: dict[str, threading.Lock] = {}
_locks_guard = threading.Lock()


def _lock(path: str) -> threading.Lock:
    with _locks_guard:
        return _locks.setdefault(path, threading.Lock())


#: Rows that one reduce task of a clustered build gets, some 12 MB of Parquet and 80 MB
#: when they are sorted, so that a sort is not spilled and a task that reads a file holds
#: little of the table; and the most reduce tasks of a build: map outputs stay countable
#: at any size.
ROWS_PER_FILE = 250_000
MAX_FILES = 20_000


def _build(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    if path not in _builds:
        with _lock(path):
            build = _published(spark, path)
            if build is None:
                name = f"build-{uuid.uuid4().hex}"
                write(f"{path}/{name}")
                try:
                    spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(f"{path}/current")
                except AnalysisException:
                    pass  # another application published its build first
                build = _published(spark, path)
            _builds[path] = build
    return _builds[path]


def materialize(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame],
                cluster_by: list[str] | None = None, files: int | None = None,
                lookup_by: list[str] | None = None, deal_by: list[str] | None = None,
                finish: Callable[[DataFrame], DataFrame] | None = None,
                rows: Callable[[], int] | None = None) -> DataFrame:
    """Read the derived table ``name`` for these inputs, building it first if
    needed. ``cluster_by`` range-partitions the rows so each file covers a
    narrow key range (good min/max statistics), in one layout at every size;
    ``files`` sets the file count. ``lookup_by`` columns get Parquet Bloom
    filters, so a lookup by a value outside the clustering skips row groups.

    ``deal_by`` and ``finish`` are for a table whose rows are wider than what they are
    derived from: the rows of ``build`` are moved by ``deal_by`` (which must give the
    order of the first ``cluster_by`` column) and become the table's in ``finish``.
    ``rows`` tells about how many there are, where counting them would run the joins."""
    path = _artifact(spark, "tables", name, inputs)

    def write(to: str) -> None:
        df = build()
        if cluster_by:
            n = files or min(MAX_FILES, max(spark.sparkContext.defaultParallelism, (rows or df.count)() // ROWS_PER_FILE + 1))
            df = df.repartitionByRange(n, *(deal_by or cluster_by))
        if finish:
            df = finish(df)
        if cluster_by:
            df = df.sortWithinPartitions(*cluster_by)
        w = df.write
        for c in lookup_by or []:
            w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
        w.parquet(to)

    return spark.read.parquet(_build(spark, path, write))


def materialize_path(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame],
                     write: Callable[[str], object] | None = None) -> str:
    """Like ``materialize`` but returns the folder (for a streaming reader).
    ``write`` writes the folder itself, for tables with a layout of their own."""
    path = _artifact(spark, "tables", name, inputs)
    return _build(spark, path, write or (lambda to: build().write.parquet(to)))


def cached_model(spark: SparkSession, name: str, inputs: list[str], train: Callable[[], object]):
    """Load the stored model ``name`` for these inputs, training and saving
    it first if needed (the scoring jobs load, as a deployed scorer does)."""
    from pyspark.ml import PipelineModel
    path = _artifact(spark, "models", name, inputs)
    key = (spark.sparkContext.applicationId, path)
    if key not in _loaded:
        build = _build(spark, path, lambda to: train().write().save(to))  # published by pointer, as tables are
        _loaded[key] = PipelineModel.load(build)
    return _loaded[key]


# Models loaded in this application, by artifact path (a path names one fit:
# it carries the fingerprint of the training inputs).
_loaded: dict[tuple[str, str], object] = {}
