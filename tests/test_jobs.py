import os
import subprocess
import sys

from pyspark.sql import functions as F

from aerolake import jobs, schemas
from aerolake.operators import requests as rq
from aerolake.plans.context import Tables
from aerolake.session import shared_path
from aerolake.sources.tables import read_jsonl
from aerolake.streaming.topics import publish, topic_records
from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_rollup_train_score_jobs(spark):
    t = Tables(spark, SF_SMALL)
    root = shared_path(spark, "test_jobs", unique=True)
    t.flights.write.parquet(root + "/flights")
    jobs.run_rollup(spark, root + "/flights", root + "/routes", files=1)
    routes = read_jsonl(spark, root + "/routes", schemas.ROUTE_DISTANCE)
    assert routes.count() == t.flights.select("Origin", "Dest").distinct().count()
    jobs.run_train(spark, root + "/flights", root + "/model", trees=3)
    publish(topic_records(rq.request_messages(t.enriched, keep=["Timestamp"]), "key", "value", "Timestamp"),
            "parquet", root + "/topic")
    qs = jobs.run_score(spark, root + "/model", "parquet", {}, root + "/topic",
                        ["json=" + root + "/out_json", "store=" + root + "/out_store",
                         "topic=" + root + "/out_topic"], root + "/ck", fanout=True, available_now=True)
    from aerolake.streaming import scoring as sc
    sc.run_to_end(qs)
    n = t.enriched.count()
    assert spark.read.parquet(root + "/out_store").count() == n
    assert spark.read.json(root + "/out_json").count() == n
    msgs = rq.parse_responses(spark.read.parquet(root + "/out_topic"))
    assert msgs.where(F.col("prediction").isNull()).count() == 0


def test_summary_regression_batch_and_correlation_jobs(spark):
    from aerolake.operators import ml, rollups
    from aerolake.streaming import scoring as sc
    t = Tables(spark, SF_SMALL)
    root = shared_path(spark, "test_more_jobs", unique=True)
    t.flights.write.parquet(root + "/flights")
    t.airplanes.write.parquet(root + "/airplanes")
    t.tasks.write.parquet(root + "/tasks")
    jobs.run_summaries(spark, root + "/flights", root + "/airplanes", root + "/sum")
    assert sorted(spark.read.parquet(root + "/sum/carriers").collect()) == sorted(rollups.carrier_summary(t.flights).collect())
    assert spark.read.parquet(root + "/sum/carrier_airplanes").count() == t.flights.select("Carrier", "TailNum").distinct().count()
    jobs.run_regress(spark, root + "/flights", root + "/line")
    assert ml.predict_delay(ml.load_model(root + "/line"), t.tasks).where("Delay IS NULL").count() == 0
    jobs.run_train(spark, root + "/flights", root + "/model", trees=3)
    jobs.run_predict(spark, root + "/tasks", root + "/model", root + "/results")
    stored = spark.read.parquet(root + "/results")
    assert stored.count() == t.tasks.count() and stored.where("prediction IS NULL").count() == 0
    day = rq.results_for_day(stored, "2024-01-15")
    assert "PartitionFilters: [isnotnull(Day" in day._jdf.queryExecution().explainString(day._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    jobs.run_results(spark, root + "/results", "2024-01-15", root + "/day")
    want = t.tasks.where("Timestamp LIKE '2024-01-15%'").count()
    assert spark.read.parquet(root + "/day").count() == want > 0
    t.keyed_requests.select("UUID", "rq_ts").write.parquet(root + "/rq")
    t.responses.select("UUID", F.col("rs_ts").cast("timestamp").alias("rs_ts"), "prediction").write.parquet(root + "/rs")
    sc.run_to_end(jobs.run_correlate(spark, root + "/rq", root + "/rs", root + "/out", root + "/ck", available_now=True))
    out = spark.read.parquet(root + "/out")
    assert 0 < out.count() == out.select("UUID").distinct().count() <= t.keyed_requests.count()


def test_quarantine_job(spark):
    from aerolake.operators import ml
    from aerolake.streaming import scoring as sc
    t = Tables(spark, SF_SMALL)
    root = shared_path(spark, "test_quarantine_job", unique=True)
    ml.save_model(ml.train_classifier(ml.training_frame(t.flights), num_trees=3), root + "/model")
    publish(topic_records(t.keyed_requests, "UUID", "value", "rq_ts"), "parquet", root + "/topic")
    qs = jobs.run_score(spark, root + "/model", "parquet", {}, root + "/topic", ["store=" + root + "/out"], root + "/ck",
                        available_now=True, quarantine=root + "/bad")
    sc.run_to_end(qs)
    bad = t.parsed.where("flight._corrupt_record IS NOT NULL").count()
    assert spark.read.json(root + "/bad").count() == bad > 0
    assert spark.read.parquet(root + "/out").count() == t.keyed_requests.count() - bad


def test_cli_help():
    out = subprocess.run([sys.executable, "-m", "aerolake.jobs", "--help"], cwd=REPO,
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and "rollup" in out.stdout


def test_cli_train_and_score_end_to_end(spark):
    t = Tables(spark, SF_SMALL)
    root = shared_path(spark, "test_cli", unique=True)
    t.flights.write.parquet(root + "/flights")
    publish(topic_records(rq.request_messages(t.enriched, keep=["Timestamp"]), "key", "value", "Timestamp"),
            "parquet", root + "/topic")
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--master local[2] pyspark-shell")
    base = [sys.executable, "-m", "aerolake.jobs"]
    r = subprocess.run(base + ["train", "--flights", root + "/flights", "--model", root + "/model", "--trees", "3"],
                       cwd=REPO, env=env, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    r = subprocess.run(base + ["score", "--model", root + "/model", "--source-format", "parquet",
                               "--source-path", root + "/topic", "--sink", "store=" + root + "/out",
                               "--sink", "json=" + root + "/out_json", "--checkpoint", root + "/ck",
                               "--available-now"],
                       cwd=REPO, env=env, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    assert spark.read.parquet(root + "/out").count() == t.enriched.count()
