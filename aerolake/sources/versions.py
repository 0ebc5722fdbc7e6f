"""A table that is published again and again while others read it.

Each publication is a folder of its own, ``<number>-<id>``; Spark's ``_SUCCESS`` marks it
complete. Readers take the complete one with the highest number (then the highest id, if
two publishers took the same number at once), so they never see a table half written,
and nothing that a reader may still hold is changed or deleted. Give the folder a
lifetime rule for old publications, or call ``prune``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from aerolake.sources.materialize import _store


def published(spark: SparkSession, root: str, complete: bool = True) -> list[str]:
    """Names of the publications, oldest first."""
    folder, store = _store(spark, root)
    if not store.exists(folder):
        return []
    names = [s.getPath().getName() for s in store.listStatus(folder) if s.isDirectory()]
    done = [n for n in names if not complete or store.exists(_store(spark, f"{root}/{n}/_SUCCESS")[0])]
    return sorted(done)


def latest(spark: SparkSession, root: str) -> str | None:
    """The publication to read, or None before the first one is complete."""
    names = published(spark, root)
    return names[-1] if names else None


def publish(df: DataFrame, root: str) -> str:
    """Write df as the next publication; its name."""
    names = published(df.sparkSession, root, complete=False)
    number = int(names[-1].split("-")[0]) + 1 if names else 0
    name = f"{number:010d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{name}")
    return name


def prune(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete all complete publications but the ``keep`` latest; their names."""
    old = published(spark, root)[:-keep] if keep > 0 else []
    for name in old:
        path, store = _store(spark, f"{root}/{name}")
        store.delete(path, True)
    return old
