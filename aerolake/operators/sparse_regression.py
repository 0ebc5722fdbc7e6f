"""Delay regression with a weight for every category: no hash slots, no dense Gram matrix (ML4).

Minimises  sum (y - prediction)^2 + ridge * sum (category weight)^2  over an intercept, the
numbers (standardised; a missing one counts as its mean) and one weight a category value
(a missing or unknown value adds nothing).

One pass over the rows sums what the normal equations need: a fixed few numbers for the
dense part, a vector a category value, and a count for each pair of values of two columns
that occur together. Conjugate gradients with a diagonal preconditioner then run on these
sums alone; the rows are not read again. Weights, residuals and directions are tables that
are joined and summed by category, written once a round; the driver holds the dense part and
a few dot products. Sums are pre-aggregated in each task, so a value that a third of the
rows has is one partial row a task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerolake.operators.joins import broadcast_if_bounded
from aerolake.operators.ml import REGRESSION_CATEGORICAL, REGRESSION_NUMERIC
from aerolake.session import shared_path

#: Values of a column up to which its weights are broadcast to the rows (some 10 MB).
WEIGHTS_MAX_ROWS = 200_000


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, "regression", name, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _dense(numeric: list[str], scale: dict[str, tuple[float, float]]) -> list[Column]:
    """Intercept, then the standardised numbers."""
    def z(c):
        mean, deviation = scale[c]
        value = F.col(c).cast("double")
        return F.when(value.isNull() | F.isnan(value), 0.0).otherwise((value - mean) / deviation)
    return [F.lit(1.0), *[z(c) for c in numeric]]


def _sum(items) -> Column:
    total = F.lit(0.0)
    for item in items:
        total = total + item
    return total


def fit(train: DataFrame, to: str, label: str = "ArrDelay", categorical: list[str] = REGRESSION_CATEGORICAL,
        numeric: list[str] = REGRESSION_NUMERIC, ridge: float = 1.0, tolerance: float = 1e-8, max_rounds: int = 1000) -> str:
    """Fit and write the model to the folder ``to``. Rows without a label can't train.

    The model is a table (kind, column, value, weight, mean, deviation): kind ``category``,
    ``dense`` (intercept and numbers) or ``info`` (rounds, the residual's norm as a part of
    the first one). Rounds end at ``tolerance``; not reaching it in ``max_rounds`` is an error.
    """
    spark = train.sparkSession
    y = F.col(label).cast("double")
    rows = train.where(y.isNotNull() & ~F.isnan(y))
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    stats = rows.agg(*[F.avg(number(c)).alias(f"m_{c}") for c in numeric], *[F.stddev_pop(number(c)).alias(f"s_{c}") for c in numeric]).first()
    scale = {c: (stats[f"m_{c}"] or 0.0, stats[f"s_{c}"] or 1.0) for c in numeric}
    dense = _dense(numeric, scale)
    k = len(dense)
    own = rows.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(categorical)], *[d.alias(f"d{i}") for i, d in enumerate(dense)], y.alias("y"))

    # The dense part: k * k sums.
    at = [(i, j) for i in range(k) for j in range(i, k)]
    got = own.agg(*[F.sum(F.col(f"d{i}") * F.col(f"d{j}")).alias(f"g_{i}_{j}") for i, j in at], *[F.sum(F.col(f"d{i}") * F.col("y")).alias(f"b_{i}") for i in range(k)]).first()
    gram = [[(got[f"g_{min(i, j)}_{max(i, j)}"] or 0.0) for j in range(k)] for i in range(k)]
    # Category values: sums with the dense part and the label.
    each = own.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"c{i}").alias("v")) for i in range(len(categorical))])).alias("f"),
                      *[f"d{i}" for i in range(k)], "y").where("f.v IS NOT NULL")
    values = each.groupBy("f.c", "f.v").agg(F.sum("y").alias("b"), *[F.sum(f"d{i}").alias(f"g{i}") for i in range(k)])
    # Pairs of values of two columns that occur together, in both directions.
    pairs = [(i, j) for i in range(len(categorical)) for j in range(i + 1, len(categorical))]
    if pairs:
        counted = own.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"c{i}").alias("v"), F.lit(j).alias("c2"), F.col(f"c{j}").alias("v2"))
                                                 for i, j in pairs])).alias("f")).where("f.v IS NOT NULL AND f.v2 IS NOT NULL")
        counted = counted.groupBy("f.c", "f.v", "f.c2", "f.v2").agg(F.count(F.lit(1)).cast("double").alias("n"))
        counted = _written(counted, "pairs")
        together = counted.unionByName(counted.selectExpr("c2 AS c", "v2 AS v", "c AS c2", "v AS v2", "n"))
    else:
        together = spark.createDataFrame([], "c int, v string, c2 int, v2 string, n double")

    # g0 is the number of rows with the value: its own diagonal entry, plus the ridge.
    scales = [gram[i][i] or 1.0 for i in range(k)]
    xd, rd = [0.0] * k, [got[f"b_{i}"] or 0.0 for i in range(k)]
    pd = [r / d for r, d in zip(rd, scales)]
    state = _written(values.select("c", "v", F.lit(0.0).alias("x"), F.col("b").alias("r"), (F.col("b") / (F.col("g0") + ridge)).alias("p"),
                                   (F.col("g0") + ridge).alias("d"), *[f"g{i}" for i in range(k)]), "state")
    rz = (state.agg(F.sum(F.col("r") * F.col("r") / F.col("d"))).first()[0] or 0.0) + sum(r * r / d for r, d in zip(rd, scales))
    first, rounds = rz, 0
    while rz > first * tolerance * tolerance:
        if rounds == max_rounds:
            raise RuntimeError(f"no solution within {max_rounds} rounds: residual {math.sqrt(rz / first):.3g} of the first")
        rounds += 1
        met = together.join(state.select(F.col("c").alias("c2"), F.col("v").alias("v2"), "p"), ["c2", "v2"]).groupBy("c", "v").agg(F.sum(F.col("n") * F.col("p")).alias("met"))
        q = F.col("d") * F.col("p") + F.coalesce("met", F.lit(0.0)) + _sum(F.col(f"g{i}") * pd[i] for i in range(k))
        now = _written(state.join(met, ["c", "v"], "left").withColumn("q", q).drop("met"), "state")
        sums = now.agg(F.sum(F.col("p") * F.col("q")).alias("pq"), F.sum(F.col("r") * F.col("q") / F.col("d")).alias("rq"),
                       F.sum(F.col("q") * F.col("q") / F.col("d")).alias("qq"), F.sum(F.col("r") * F.col("r") / F.col("d")).alias("rr"),
                       *[F.sum(F.col(f"g{i}") * F.col("p")).alias(f"gp{i}") for i in range(k)]).first()
        qd = [sum(gram[i][j] * pd[j] for j in range(k)) + (sums[f"gp{i}"] or 0.0) for i in range(k)]
        alpha = rz / ((sums["pq"] or 0.0) + sum(a * b for a, b in zip(pd, qd)))
        xd, rd = [x + alpha * p for x, p in zip(xd, pd)], [r - alpha * w for r, w in zip(rd, qd)]
        after = (sums["rr"] or 0.0) - 2 * alpha * (sums["rq"] or 0.0) + alpha * alpha * (sums["qq"] or 0.0)
        after = max(after, 0.0) + sum(r * r / d for r, d in zip(rd, scales))
        beta, rz = after / rz, after
        pd = [r / d + beta * p for r, d, p in zip(rd, scales, pd)]
        r = F.col("r") - alpha * F.col("q")
        state = now.select("c", "v", (F.col("x") + alpha * F.col("p")).alias("x"), r.alias("r"), (r / F.col("d") + beta * F.col("p")).alias("p"),
                           "d", *[f"g{i}" for i in range(k)])

    names = F.array(*[F.lit(c) for c in categorical])
    weights = state.select(F.lit("category").alias("kind"), names[F.col("c")].alias("column"), F.col("v").alias("value"), F.col("x").alias("weight"),
                           F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("deviation"))
    few = [("dense", "", None, xd[0], None, None)] + [("dense", c, None, w, *scale[c]) for c, w in zip(numeric, xd[1:])]
    few += [("info", "rounds", None, float(rounds), None, None), ("info", "residual", None, math.sqrt(rz / first) if first else 0.0, None, None),
            ("info", "ridge", None, ridge, None, None)]
    weights.unionByName(spark.createDataFrame(few, weights.schema)).write.partitionBy("kind").parquet(to)
    return to


def _part(spark: SparkSession, model: str, kind: str) -> DataFrame:
    rows = spark.read.schema("column string, value string, weight double, mean double, deviation double, kind string").parquet(model)
    return rows.where(F.col("kind") == kind).drop("kind")


def report(spark: SparkSession, model: str) -> dict[str, float]:
    """rounds, residual (norm as a part of the first one) and ridge of a model."""
    return {r["column"]: r["weight"] for r in _part(spark, model, "info").collect()}


def predict(model: str, df: DataFrame, output: str = "Delay") -> DataFrame:
    """df with the predicted delay minutes."""
    spark = df.sparkSession
    dense = {r["column"]: r for r in _part(spark, model, "dense").collect()}  # as many rows as numbers
    numeric = [c for c in dense if c]
    columns = _dense(numeric, {c: (dense[c]["mean"], dense[c]["deviation"]) for c in numeric})
    total = _sum(F.lit(dense[c]["weight"]) * z for c, z in zip(["", *numeric], columns))
    weights = _part(spark, model, "category").select("column", "value", "weight")
    out, names = df, [r["column"] for r in weights.select("column").distinct().collect()]  # as many rows as columns
    for i, c in enumerate(sorted(names)):
        own = weights.where(F.col("column") == c).select(F.col("value").alias(f"_v{i}"), F.col("weight").alias(f"_w{i}"))
        out = out.join(broadcast_if_bounded(own, WEIGHTS_MAX_ROWS), F.col(c).cast("string") == F.col(f"_v{i}"), "left").drop(f"_v{i}")
        total = total + F.coalesce(f"_w{i}", F.lit(0.0))
    return out.withColumn(output, total).drop(*[f"_w{i}" for i in range(len(names))])


def gradients(model: str, train: DataFrame, label: str = "ArrDelay") -> DataFrame:
    """(column, value, n, mean_gradient) of every category: what is left of its normal
    equation, computed from the predictions of the rows, per row. All zero at the optimum
    and nowhere else."""
    spark = train.sparkSession
    ridge = report(spark, model)["ridge"]
    weights = _part(spark, model, "category").select("column", "value", "weight")
    names = [r["column"] for r in weights.select("column").distinct().collect()]
    y = F.col(label).cast("double")
    off = predict(model, train.where(y.isNotNull() & ~F.isnan(y)), "_delay").withColumn("_off", y - F.col("_delay"))
    sums = off.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in sorted(names)])).alias("f"), "_off")
    sums = sums.where("f.value IS NOT NULL").groupBy("f.column", "f.value").agg(F.count(F.lit(1)).alias("n"), F.sum("_off").alias("off"))
    return sums.join(weights, ["column", "value"], "left").select("column", "value", "n", (F.round((F.col("off") - ridge * F.coalesce("weight", F.lit(0.0))) / F.col("n"), 5) + 0.0).alias("mean_gradient"))
