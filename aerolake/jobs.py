"""spark-submit entry points for the programs a deployment runs.

    python -m aerolake.jobs rollup     --flights F --out DIR [--files N]
    python -m aerolake.jobs summaries  --flights F --airplanes A --out DIR
    python -m aerolake.jobs refresh    --flights F --store DIR --out DIR
    python -m aerolake.jobs train      --flights F --model DIR [--trees N --seed S]
    python -m aerolake.jobs regress    --flights F --model DIR [--slots N]
    python -m aerolake.jobs predict    --tasks DIR --model DIR --results DIR
    python -m aerolake.jobs results    --results DIR --day 2024-01-15 --out DIR
    python -m aerolake.jobs score      --model DIR --source-format kafka
                                       --source-option kafka.bootstrap.servers=host:9092
                                       --source-option subscribe=requests
                                       --sink json=DIR --sink store=DIR
                                       --sink topic=kafka:kafka.bootstrap.servers=host:9092,topic=responses
                                       --checkpoint DIR [--fanout | --separate] [--available-now]
                                       [--quarantine DIR]
    python -m aerolake.jobs correlate  --requests DIR --responses DIR --out DIR --checkpoint DIR
                                       [--limit-seconds N] [--available-now]

``rollup`` writes the route-distance table as JSON Lines (the reference's batch
job); ``summaries`` writes the month, carrier, carrier-airplane and manufacturer
tables that pages read by key; ``refresh`` brings the flight summaries up to date from
the files appended since the last refresh; ``train`` and ``regress`` fit and store the models;
``predict`` scores stored tasks into the result table, a folder for each day, and
``results`` reads one day of it; ``score`` runs the scoring stream into the given
sinks and blocks until a query ends, re-raising its failure (``--quarantine`` sets
malformed messages apart); ``correlate`` matches replies to requests. Hosts, topics
and paths are arguments only.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from aerolake.operators import incremental, ml, rollups
from aerolake.operators import requests as rq
from aerolake import schemas
from aerolake.session import get_session
from aerolake.sources.tables import write_jsonl
from aerolake.streaming import correlate as corr
from aerolake.streaming import scoring as sc
from aerolake.streaming.topics import read_topic


def run_rollup(spark: SparkSession, flights_path: str, out: str, files: int | None = None) -> str:
    """Route distances from a flight table, written as JSON Lines (AGG1, SNK1)."""
    flights = spark.read.parquet(flights_path)
    return write_jsonl(rollups.route_distance(flights), out, files=files)


def run_train(spark: SparkSession, flights_path: str, model_path: str, trees: int = 10, seed: int = 1) -> str:
    """Fit indexers + assembler + forest on a flight table and store it (ML3)."""
    flights = spark.read.parquet(flights_path)
    model = ml.train_classifier(ml.training_frame(flights), num_trees=trees, seed=seed)
    return ml.save_model(model, model_path)


def run_summaries(spark: SparkSession, flights_path: str, airplanes_path: str, out: str) -> str:
    """The finished summaries (AGG4, AGG5, AGG7, SRC6), one table each under ``out``."""
    flights, airplanes = spark.read.parquet(flights_path), spark.read.parquet(airplanes_path)
    for name, df in {"months": rollups.flights_by_month(flights), "carriers": rollups.carrier_summary(flights),
                     "carrier_airplanes": rollups.airplanes_per_carrier(flights),
                     "manufacturers": rollups.manufacturer_totals(airplanes)}.items():
        df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")
    return out


def run_refresh(spark: SparkSession, flights_path: str, store: str, out: str) -> int:
    """Fold the files appended to the flights into ``store`` and write the summaries
    (AGG1, AGG4, AGG7) under ``out``; returns how many files were read."""
    summaries = {"routes": incremental.route_distance(), "months": incremental.flights_by_month(),
                 "carrier_airplanes": incremental.airplanes_per_carrier()}
    read = incremental.refresh(spark, flights_path, store, summaries)
    for name, summary in summaries.items():
        incremental.result(spark, store, name, summary).write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")
    return read


def run_regress(spark: SparkSession, flights_path: str, model_path: str, slots: int = 1 << 10) -> str:
    """Fit the delay-minutes regression and store it (ML4)."""
    flights = rq.with_date_parts(spark.read.parquet(flights_path))
    return ml.save_model(ml.train_regressor(flights, num_features=slots), model_path)


def run_predict(spark: SparkSession, tasks_path: str, model_path: str, results_path: str) -> str:
    """Score stored tasks and append them to the result table (ML5)."""
    tasks = spark.read.schema(schemas.TASK).parquet(tasks_path)
    return rq.store_results(ml.score(ml.load_model(model_path), tasks), results_path)


def run_results(spark: SparkSession, results_path: str, day: str, out: str) -> str:
    """One day of the result table (FIL5)."""
    rq.results_for_day(spark.read.parquet(results_path), day).write.mode("overwrite").parquet(out)
    return out


def run_correlate(spark: SparkSession, requests: str, responses: str, out: str, checkpoint: str,
                  limit_seconds: int = 20, available_now: bool = False):
    """Match replies to requests (JOIN4): (UUID, rq_ts) and (UUID, rs_ts, prediction)
    folders in, (UUID, status, prediction) files out."""
    a = spark.readStream.schema("UUID string, rq_ts timestamp").parquet(requests)
    b = spark.readStream.schema("UUID string, rs_ts timestamp, prediction double").parquet(responses)
    w = (corr.correlate(a, b, limit_seconds).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w).start(out)


def _kv(items: list[str]) -> dict[str, str]:
    out = {}
    for item in items:
        k, _, v = item.partition("=")
        out[k] = v
    return out


def _sink_writers(specs: list[str]) -> dict[str, sc.BatchWriter]:
    """``json=DIR``, ``store=DIR``, ``topic=DIR`` (file stand-in) or
    ``topic=kafka:k=v,k=v``, ``external=FORMAT:k=v,...`` (e.g. a store connector)."""
    writers: dict[str, sc.BatchWriter] = {}
    for spec in specs:
        kind, _, target = spec.partition("=")
        if kind == "json":
            writers[kind] = sc.json_writer(target)
        elif kind == "store":
            writers[kind] = sc.store_writer(target)
        elif kind == "topic":
            fmt, sep, opts = target.partition(":")
            if sep and fmt == "kafka":
                writers[kind] = sc.topic_writer("kafka", options=_kv(opts.split(",")))
            else:
                writers[kind] = sc.topic_writer("parquet", target)
        elif kind == "external":
            fmt, _, opts = target.partition(":")
            writers[kind] = sc.format_writer(fmt, _kv([o for o in opts.split(",") if o]))
        else:
            raise ValueError(f"unknown sink {kind!r}")
    return writers


def run_score(spark: SparkSession, model_path: str, source_format: str, source_options: dict[str, str],
              source_path: str | None, sinks: list[str], checkpoint: str, fanout: bool = True,
              available_now: bool = False, console: bool = False, quarantine: str | None = None) -> list:
    """Start the scoring stream (STR1) into the sinks; returns the queries."""
    model = ml.load_model(model_path)
    topic = read_topic(spark, source_format, source_path, source_options)
    scored = sc.score_stream(topic, model, drop_corrupt=quarantine is not None)
    trigger = {"availableNow": True} if available_now else None
    writers = _sink_writers(sinks)
    if quarantine:
        queries = [sc.start_scoring_with_quarantine(topic, model, writers, sc.json_writer(quarantine), checkpoint, trigger)]
    elif fanout:
        queries = [sc.start_fanout(scored, writers, checkpoint, trigger)]
    else:
        queries = sc.start_separate(scored, writers, checkpoint, trigger)
    if console:
        queries.append(sc.start_console_sink(scored, trigger))
    return queries


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="aerolake.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("rollup")
    r.add_argument("--flights", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--files", type=int)
    t = sub.add_parser("train")
    t.add_argument("--flights", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--trees", type=int, default=10)
    t.add_argument("--seed", type=int, default=1)
    m = sub.add_parser("summaries")
    m.add_argument("--flights", required=True)
    m.add_argument("--airplanes", required=True)
    m.add_argument("--out", required=True)
    f = sub.add_parser("refresh")
    f.add_argument("--flights", required=True)
    f.add_argument("--store", required=True)
    f.add_argument("--out", required=True)
    g = sub.add_parser("regress")
    g.add_argument("--flights", required=True)
    g.add_argument("--model", required=True)
    g.add_argument("--slots", type=int, default=1 << 10)
    b = sub.add_parser("predict")
    b.add_argument("--tasks", required=True)
    b.add_argument("--model", required=True)
    b.add_argument("--results", required=True)
    d = sub.add_parser("results")
    d.add_argument("--results", required=True)
    d.add_argument("--day", required=True)
    d.add_argument("--out", required=True)
    c = sub.add_parser("correlate")
    c.add_argument("--requests", required=True)
    c.add_argument("--responses", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--checkpoint", required=True)
    c.add_argument("--limit-seconds", type=int, default=20)
    c.add_argument("--available-now", action="store_true")
    s = sub.add_parser("score")
    s.add_argument("--quarantine")
    s.add_argument("--model", required=True)
    s.add_argument("--source-format", default="kafka")
    s.add_argument("--source-option", action="append", default=[])
    s.add_argument("--source-path")
    s.add_argument("--sink", action="append", required=True)
    s.add_argument("--checkpoint", required=True)
    mode = s.add_mutually_exclusive_group()
    mode.add_argument("--fanout", dest="fanout", action="store_true", default=True)
    mode.add_argument("--separate", dest="fanout", action="store_false")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--console", action="store_true")
    a = p.parse_args(argv)

    spark = get_session()
    if a.cmd == "rollup":
        run_rollup(spark, a.flights, a.out, a.files)
    elif a.cmd == "train":
        run_train(spark, a.flights, a.model, a.trees, a.seed)
    elif a.cmd == "summaries":
        run_summaries(spark, a.flights, a.airplanes, a.out)
    elif a.cmd == "refresh":
        run_refresh(spark, a.flights, a.store, a.out)
    elif a.cmd == "regress":
        run_regress(spark, a.flights, a.model, a.slots)
    elif a.cmd == "predict":
        run_predict(spark, a.tasks, a.model, a.results)
    elif a.cmd == "results":
        run_results(spark, a.results, a.day, a.out)
    elif a.cmd == "correlate":
        query = run_correlate(spark, a.requests, a.responses, a.out, a.checkpoint, a.limit_seconds, a.available_now)
        if a.available_now:
            sc.run_to_end(query)
        else:
            sc.await_any(spark)
    else:
        queries = run_score(spark, a.model, a.source_format, _kv(a.source_option), a.source_path,
                            a.sink, a.checkpoint, a.fanout, a.available_now, a.console, a.quarantine)
        if a.available_now:
            sc.run_to_end(queries)
        else:
            sc.await_any(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
