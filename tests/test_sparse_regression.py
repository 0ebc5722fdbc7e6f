"""Delay regression on sparse categories against a dense least-squares solution."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.operators import ml, requests as rq, sparse_regression as sr
from aerolake.plans.context import Tables
from aerolake.session import shared_path
from conftest import SF_SMALL

CAT, NUM = ml.REGRESSION_CATEGORICAL, ml.REGRESSION_NUMERIC


def solved(rows, ridge):
    """Predictions by a dense solver over all columns."""
    def numbers(c):
        v = np.array([np.nan if r[c] is None else float(r[c]) for r in rows])
        sd = np.nanstd(v)
        return np.nan_to_num((v - np.nanmean(v)) / (sd or 1.0))
    names = sorted({(c, r[c]) for r in rows for c in CAT if r[c] is not None})
    at = {n: i for i, n in enumerate(names)}
    x = np.zeros((len(rows), 1 + len(NUM) + len(names)))
    x[:, 0] = 1
    for j, c in enumerate(NUM):
        x[:, 1 + j] = numbers(c)
    for i, r in enumerate(rows):
        for c in CAT:
            if r[c] is not None:
                x[i, 1 + len(NUM) + at[c, r[c]]] = 1
    y = np.array([r["ArrDelay"] for r in rows])
    penalty = np.diag([0.0] * (1 + len(NUM)) + [ridge] * len(names))
    return x @ np.linalg.lstsq(x.T @ x + penalty, x.T @ y, rcond=None)[0]


def check(spark, train, ridge=1.0):
    model = sr.fit(train, shared_path(spark, "test_regression", unique=True) + "/m", ridge=ridge)
    rows = train.where("ArrDelay IS NOT NULL").collect()
    want = solved(rows, ridge)
    got = {r["id"]: r["Delay"] for r in sr.predict(model, train).collect()}
    assert np.allclose([got[r["id"]] for r in rows], want, atol=1e-5)
    assert sr.report(spark, model)["residual"] <= 1e-8
    return model


def test_equals_dense_solution(spark):
    flights = rq.with_date_parts(Tables(spark, SF_SMALL).flights).where("FlightId < '4'").withColumnRenamed("FlightId", "id")
    model = check(spark, flights)
    assert sr.gradients(model, flights).where("mean_gradient <> 0").count() == 0


def test_more_categories_than_hash_slots_nulls_and_ties(spark):
    n = 3000
    df = spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 != 0, F.concat(F.lit("o"), F.col("id") % 11)).alias("Origin"),
        F.concat(F.lit("d"), F.pmod(F.hash("id"), F.lit(17))).alias("Dest"), (F.col("id") % 1100).cast("string").alias("FlightNum"),
        F.when(F.col("id") % 5 > 0, (F.col("id") * 37 % 500).cast("double")).alias("Distance"), (F.col("id") % 365).cast("int").alias("DayOfYear"),
        F.lit(3).alias("DayOfMonth"), (F.col("id") % 7).cast("int").alias("DayOfWeek"),
        F.when(F.col("id") % 13 > 0, (F.pmod(F.hash(F.lit(1), "id"), F.lit(200)) - 50).cast("double")).alias("ArrDelay"), F.lit("x").alias("value"))
    model = check(spark, df, ridge=0.5)
    one = spark.createDataFrame([(None, "unseen", "9999999", None, None, None, None)],
                                "Origin string, Dest string, FlightNum string, Distance double, DayOfYear int, DayOfMonth int, DayOfWeek int")
    assert sr.predict(model, one).first()["Delay"] is not None


@pytest.mark.parametrize("label", [None, 4.0])
def test_no_or_one_label(spark, label):
    df = spark.createDataFrame([("A", "B", "1", 5.0, 1, 1, 1, label)],
                               "Origin string, Dest string, FlightNum string, Distance double, DayOfYear int, DayOfMonth int, DayOfWeek int, ArrDelay double")
    model = sr.fit(df, shared_path(spark, "test_regression", unique=True) + "/m")
    assert sr.predict(model, df).first()["Delay"] == pytest.approx(label or 0.0)


def test_no_solution_is_an_error(spark):
    flights = rq.with_date_parts(Tables(spark, SF_SMALL).flights).where("FlightId < '1'")
    with pytest.raises(RuntimeError, match="no solution"):
        sr.fit(flights, shared_path(spark, "test_regression", unique=True) + "/m", max_rounds=1)
