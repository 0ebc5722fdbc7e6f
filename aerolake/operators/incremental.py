"""Summaries kept up to date from appended files alone (AGG1, AGG4, AGG5, AGG7).

A summary's state can be merged: sums and counts by key, or the distinct keys themselves.
``refresh`` lists the input folder, reads the files that no earlier refresh has read, and
writes their partial states as a new generation; ``result`` merges the generations'
states, which are as small as the summaries, and never reads the input. Once there are
``MERGE_AT`` generations they are merged into one.

A generation is written to a folder of its own and then named by a new version of the
store, a small text folder that is created once: of two refreshes at a time one fails
and leaves what it wrote unnamed. A refresh that was cut short is simply made again.
A file is known by its path, length and time. If a known one is gone or has changed the
states can't be told apart from the rest any more, and all files are read anew.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolake.sources.materialize import _store

MERGE_AT = 8
FILE = ["path", "length", "modificationTime"]


@dataclass(frozen=True)
class Summary:
    """States by ``keys``: ``sums`` names aggregates of input rows that add up (sums and
    counts, as SQL). Without any, the state is the set of the keys. ``finish`` makes the answer."""

    keys: tuple[str, ...]
    finish: Callable[[DataFrame], DataFrame]
    sums: dict[str, str] = field(default_factory=dict)

    def partial(self, rows: DataFrame) -> DataFrame:
        if not self.sums:
            return rows.select(*self.keys).distinct()
        return rows.groupBy(*self.keys).agg(*[F.expr(c).alias(n) for n, c in self.sums.items()])

    def merged(self, states: DataFrame) -> DataFrame:
        if not self.sums:
            return states.distinct()
        return states.groupBy(*self.keys).agg(*[F.sum(n).alias(n) for n in self.sums])


def route_distance() -> Summary:
    """Mean distance per route (AGG1). Routes without any distance have none."""
    return Summary(("Origin", "Dest"), lambda s: s.select("Origin", "Dest", (F.col("total") / F.when(F.col("n") > 0, F.col("n"))).alias("Distance")),
                   {"total": "sum(cast(Distance AS double))", "n": "count(Distance)"})


def flights_by_month() -> Summary:
    """Flights per month (AGG4)."""
    return Summary(("Year", "Month"), lambda s: s, {"total_flights": "count(1)"})


def manufacturer_totals() -> Summary:
    """Airplanes per manufacturer (AGG5), over a table with a row for each airplane."""
    return Summary(("Manufacturer",), lambda s: s, {"total_airplanes": "count(1)"})


def airplanes_per_carrier() -> Summary:
    """Distinct airplanes of every carrier (AGG7): the pairs are the state, so an airplane that
    comes again in a later file counts once."""
    def finish(pairs: DataFrame) -> DataFrame:
        return pairs.join(pairs.groupBy("Carrier").agg(F.count(F.lit(1)).alias("n_airplanes")), "Carrier")
    return Summary(("Carrier", "TailNum"), finish)


def _state(spark: SparkSession, store: str) -> dict:
    """The last version: its number and its generations, oldest first."""
    path, files = _store(spark, f"{store}/versions")
    names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    for n in sorted((int(name.split("=")[1]) for name in names), reverse=True):
        done, _ = _store(spark, f"{store}/versions/n={n}/_SUCCESS")
        if files.exists(done):
            return json.loads(spark.read.text(f"{store}/versions/n={n}").first()["value"])
    return {"version": 0, "generations": []}


def _publish(spark: SparkSession, store: str, before: dict, generations: list[str]) -> None:
    n = before["version"] + 1
    state = json.dumps({"version": n, "generations": generations})
    spark.createDataFrame([(state,)], "value string").coalesce(1).write.text(f"{store}/versions/n={n}")


def _read(spark: SparkSession, store: str, generations: list[str], name: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [spark.read.parquet(f"{store}/{g}/{name}") for g in generations])


def refresh(spark: SparkSession, source: str, store: str, summaries: dict[str, Summary], merge_at: int = MERGE_AT) -> int:
    """Fold the files appended to ``source`` (a Parquet folder) into the states of
    ``store``; returns how many were read."""
    before = _state(spark, store)
    generations = list(before["generations"])
    # Files are listed by Spark, contents unread.
    now = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(source).select(*FILE)
    if generations:
        known = _read(spark, store, generations, "files")
        if known.join(now, FILE, "left_anti").isEmpty():
            now_new = now.join(known, FILE, "left_anti")
        else:
            generations, now_new = [], now
    else:
        now_new = now
    # The names of the appended files: Spark's reader holds them on the driver as well.
    listed = [tuple(r) for r in now_new.collect()]
    if listed:
        name = f"generation-{uuid.uuid4().hex}"
        rows = spark.read.option("basePath", source).parquet(*[r[0] for r in listed])
        for s, summary in summaries.items():
            summary.partial(rows).write.parquet(f"{store}/{name}/{s}")
        spark.createDataFrame(listed, now.schema).write.parquet(f"{store}/{name}/files")
        generations.append(name)
    if len(generations) >= merge_at:
        name = f"generation-{uuid.uuid4().hex}"
        for s, summary in summaries.items():
            summary.merged(_read(spark, store, generations, s)).write.parquet(f"{store}/{name}/{s}")
        _read(spark, store, generations, "files").write.parquet(f"{store}/{name}/files")
        generations = [name]
    if generations != before["generations"]:
        _publish(spark, store, before, generations)
    return len(listed)


def result(spark: SparkSession, store: str, name: str, summary: Summary) -> DataFrame:
    """The summary of all files folded in so far."""
    generations = _state(spark, store)["generations"]
    if not generations:
        raise ValueError(f"{store} has not been refreshed yet")
    return summary.finish(summary.merged(_read(spark, store, generations, name)))
