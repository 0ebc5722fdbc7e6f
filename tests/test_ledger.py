"""Exactly-once fan-out and enrichment by a table that is published anew."""

import pytest
from pyspark.sql import functions as F

from aerolake.operators import requests as rq
from aerolake.session import shared_path
from aerolake.sources import versions
from aerolake.streaming import enrich, ledger
from aerolake.streaming import scoring as sc
from aerolake.streaming.topics import as_text
from aerolake.schemas import RESPONSE_FIELDS

NOW = {"availableNow": True}
N = 60


@pytest.fixture(scope="module")
def scored(spark):
    """Two files of scored rows; every third row is one of nulls, equal in all batches."""
    root = shared_path(spark, "test_ledger", unique=True)
    blank = [F.lit(None).cast("string").alias(c) for c in RESPONSE_FIELDS if c not in ("UUID", "prediction")]
    rows = spark.range(N).select(F.when(F.col("id") % 3 > 0, F.md5(F.col("id").cast("string"))).alias("UUID"),
                                 F.when(F.col("id") % 3 > 0, (F.col("id") % 4).cast("double")).alias("prediction"), *blank)
    for n in range(2):
        rows.coalesce(1).limit(N).write.mode("append").parquet(f"{root}/in")
    return rows.schema, f"{root}/in"


class Flaky:
    """Fails once, at its second call: before it writes, or after half or all of its rows."""

    def __init__(self, write, when):
        self.write, self.when, self.calls = write, when, 0

    def __call__(self, rows, *args):
        self.calls += 1
        if self.calls == 2:
            if self.when == "half":
                self.write(rows.where("UUID IS NULL OR UUID < '8'" if "UUID" in rows.columns else "key IS NULL OR cast(key AS string) < '8'"), *args)
            if self.when == "after":
                self.write(rows, *args)
            raise ValueError("sink down")
        self.write(rows, *args)


@pytest.mark.parametrize("when", ["before", "half", "after"])
@pytest.mark.parametrize("which", ["store", "json", "topic"])
def test_failing_sink_duplicates_and_loses_nothing(spark, scored, which, when):
    schema, path = scored
    root = shared_path(spark, "test_once", unique=True)
    topic = ledger.AppendTopic("scores", path=f"{root}/topic")
    sinks = {"store": sc.store_writer(f"{root}/store"), "json": sc.json_writer(f"{root}/json"), "topic": topic}
    if which == "topic":
        topic.send = Flaky(topic.send, when)
    else:
        sinks[which] = Flaky(sinks[which], when)

    def start():
        df = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        return ledger.start_fanout_once(df, sinks, f"{root}/ck", NOW)
    with pytest.raises(Exception):
        sc.run_to_end(start())
    sc.run_to_end(start())
    sc.run_to_end(start())  # nothing new: nothing written
    want = sorted((r["UUID"] or "", r["prediction"] or 0.0) for r in spark.read.parquet(path).collect())
    held = {"store": spark.read.parquet(f"{root}/store"), "json": spark.read.schema(schema).json(f"{root}/json"),
            "topic": rq.parse_responses(as_text(spark.read.parquet(f"{root}/topic")).select("value"))}
    for name, rows in held.items():
        assert sorted((r["UUID"] or "", r["prediction"] or 0.0) for r in rows.collect()) == want, name


def test_done_sinks_are_not_called_again(spark, scored):
    root = shared_path(spark, "test_done", unique=True)
    book, calls = ledger.Ledger(spark, root), []
    guarded = ledger.once(book, "s", lambda rows, n: calls.append(n))
    for n in (0, 0, 1, 1, 0):
        guarded(None, n)
    assert calls == [0, 1]


def test_notes_stay_and_old_ones_go(spark):
    book = ledger.Ledger(spark, shared_path(spark, "test_notes", unique=True), keep=3)
    assert book.get("a", 0) is None
    assert book.put("a", 0, "x") == "x" and book.put("a", 0, "y") == "x"
    for n in range(1, 5):
        book.put("a", n, str(n))
    assert [book.get("a", n) for n in range(5)] == [None, None, "2", "3", "4"]


def test_versions(spark):
    root = shared_path(spark, "test_versions", unique=True)
    assert versions.latest(spark, root) is None
    names = [versions.publish(spark.range(n), root) for n in range(1, 4)]
    assert versions.published(spark, root) == names
    half = f"{root}/0000000009-half"  # being written: no _SUCCESS
    spark._jvm.java.io.File(half).mkdirs()
    assert versions.latest(spark, root) == names[-1]
    assert versions.publish(spark.range(7), root) > "0000000010"
    assert versions.prune(spark, root, keep=2) == names[:2]
    assert versions.published(spark, root)[0] == names[-1]


def test_route_table_swapped_between_batches(spark):
    root = shared_path(spark, "test_enrich", unique=True)
    ask = lambda u, o, d: spark.createDataFrame([(u, o, d)], "UUID string, Origin string, Dest string").coalesce(1).write.mode("append").parquet(f"{root}/in")
    routes = lambda *rows: versions.publish(spark.createDataFrame(rows, enrich.ROUTES), f"{root}/routes")
    failed = []

    def run(fail=False):
        def write(rows, n):
            sc.store_writer(f"{root}/out")(rows, n)
            if fail:
                failed.append(n)
                raise ValueError("down")
        df = spark.readStream.schema("UUID string, Origin string, Dest string").parquet(f"{root}/in")
        sc.run_to_end(enrich.start_enriched(df, f"{root}/routes", write, f"{root}/ck", trigger=NOW))
    ask("a", "X", "Y")
    run()  # nothing is published yet
    routes(("X", "Y", 10.0))
    ask("b", "X", "Y")
    ask("c", "X", "Z")
    run()
    ask("d", "X", "Y")
    with pytest.raises(Exception):
        run(fail=True)
    routes(("X", "Y", 20.0), ("X", "Z", 5.0))
    run()  # the failed batch, with the routes it had
    ask("e", "X", "Y")
    ask("f", "X", "Z")
    run()
    got = {r["UUID"]: r["Distance"] for r in spark.read.parquet(f"{root}/out").collect()}
    assert failed and got == {"a": None, "b": 10.0, "c": None, "d": 10.0, "e": 20.0, "f": 5.0}
