"""Delay models on DataFrames (ML1-5): index, assemble, forest, regression.

Everything runs in ``pyspark.ml``: indexers count categories with one
distributed aggregation, the forest trains from per-partition histograms, and
scoring is a per-row JVM transform (no Python in the scoring path).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import FeatureHasher, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from aerolake.functions.labels import delay_class
from aerolake.operators.requests import with_date_parts, with_route
from aerolake.session import scan_split

INDEXED = ["Carrier", "Origin", "Dest", "Route"]
INDEX_COLS = [f"{c}_index" for c in INDEXED]
NUMERIC = ["DepDelay", "Distance", "DayOfYear", "DayOfMonth", "DayOfWeek"]
LABEL = "ArrDelayBucket"
#: Bytes of files that one training task reads; the forest's copy of them is some four times as large.
TRAIN_SPLIT = "16m"
SCORE_DROP = ["rawPrediction", "probability", "features", *INDEX_COLS, *[f"{c}_rank" for c in INDEX_COLS]]


def training_frame(flights: DataFrame) -> DataFrame:
    """Flights with the scoring features and the class label (SCA11 of ArrDelay)."""
    df = with_route(with_date_parts(flights))
    return df.withColumn(LABEL, delay_class("ArrDelay"))


def _indexer() -> StringIndexer:
    # One multi-column indexer: one aggregation job counts all four columns.
    return StringIndexer(inputCols=INDEXED, outputCols=INDEX_COLS, handleInvalid="keep",
                         stringOrderType="frequencyDesc")


def _assembler(handle_invalid: str = "keep") -> VectorAssembler:
    """``keep``: a missing number becomes NaN and the row is still scored (the
    reference's setting); ``skip``: the row is left out (quarantine it first
    with ``incomplete_rows`` to keep it)."""
    return VectorAssembler(inputCols=NUMERIC + INDEX_COLS, outputCol="features", handleInvalid=handle_invalid)


def incomplete_rows(df: DataFrame) -> DataFrame:
    """Rows that ``handleInvalid="skip"`` would drop: a numeric feature is null or NaN."""
    bad = None
    for c in NUMERIC:
        cond = F.col(c).isNull() | F.isnan(F.col(c))
        bad = cond if bad is None else (bad | cond)
    return df.where(bad)


def assemble_features(train: DataFrame, df: DataFrame | None = None, handle_invalid: str = "keep") -> DataFrame:
    """Indexed and assembled feature vectors (ML1)."""
    idx = _indexer().fit(train)
    return _assembler(handle_invalid).transform(idx.transform(train if df is None else df))


def train_classifier(train: DataFrame, num_trees: int = 10, max_depth: int = 5, seed: int = 1,
                     max_bins: int = 4096, as_rank: tuple[str, ...] = ()) -> PipelineModel:
    """Fit indexers + assembler + random forest (ML3).

    The four text columns are categories, and the forest needs a bin for each value
    of the widest (+1 for the "keep" slot). If one has more values than ``max_bins``
    allows, that is an error naming the column, never a silent change of the model.
    Columns named in ``as_rank`` are given to the forest as a number instead, their
    frequency rank, at any size. ``StringIndexer`` keeps each column's distinct
    values on the driver. The forest keeps the training rows in memory and reads
    them once for each level, so files are read in splits of ``TRAIN_SPLIT``.
    """
    unknown = set(as_rank) - set(INDEXED)
    if unknown:
        raise ValueError(f"not a category column: {sorted(unknown)}")
    data = train.select(*INDEXED, *NUMERIC, LABEL).where(F.col(LABEL).isNotNull())
    idx = _indexer().fit(data)
    sizes = {c: len(labels) + 1 for c, labels in zip(INDEXED, idx.labelsArray) if c not in as_rank}
    for c, n in sizes.items():
        if n > max_bins:
            raise ValueError(f"{c} has {n - 1} values, more than max_bins={max_bins} can hold: "
                             f"raise max_bins or name {c} in as_rank")
    stages, inputs = [idx], NUMERIC + [f"{c}_index_rank" if c in as_rank else f"{c}_index" for c in INDEXED]
    if as_rank:
        # An arithmetic expression drops the nominal metadata: numeric feature.
        sql = "SELECT *, " + ", ".join(f"{c}_index + 0.0 AS {c}_index_rank" for c in as_rank) + " FROM __THIS__"
        stages.append(SQLTransformer(statement=sql))
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    rf = RandomForestClassifier(labelCol=LABEL, featuresCol="features", numTrees=num_trees,
                                maxDepth=max_depth, maxBins=max([32, *sizes.values()]), seed=seed)
    with scan_split(train.sparkSession, TRAIN_SPLIT):
        return Pipeline(stages=stages + [assembler, rf]).fit(data)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline (SRC5)."""
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Score requests (ML2) and drop the model's work columns (PRJ3). Index
    fields a message may carry are dropped first: the pipeline makes them."""
    base = df.drop(*INDEX_COLS)
    if "Route" not in base.columns:
        base = with_route(base)
    return model.transform(base).drop(*SCORE_DROP)


def hash_split(df: DataFrame, key: str, test_fraction: float) -> tuple[DataFrame, DataFrame]:
    """Train/test split by a hash of the row key: deterministic on retry and
    across runs, no per-partition sort (``randomSplit`` sorts every partition
    to be repeatable), and a given key always lands on the same side. The first
    four hex digits of the key's MD5 are compared with the fraction's."""
    bucket = F.substring(F.md5(F.col(key).cast("string")), 1, 4)
    cut = F.lit(f"{int(round(test_fraction * 65536)):04x}" if test_fraction < 1 else "g")
    return df.where(bucket >= cut), df.where(bucket < cut)


def train_metrics(train_df: DataFrame, num_trees: int = 10, seed: int = 1, test_fraction: float = 0.2,
                  key: str | None = "FlightId") -> DataFrame:
    """Hold-out accuracy of the classifier against the majority class (one row)."""
    data = train_df.where(F.col(LABEL).isNotNull())
    if key and key in data.columns:
        train, test = hash_split(data, key, test_fraction)
    else:
        train, test = data.randomSplit([1.0 - test_fraction, test_fraction], seed=seed)
    model = train_classifier(train, num_trees=num_trees, seed=seed)
    pred = model.transform(test.select(*INDEXED, *NUMERIC, LABEL)).select(LABEL, "prediction")
    by_class = pred.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"), F.sum((F.col(LABEL) == F.col("prediction")).cast("long")).alias("hit"))
    return by_class.agg(F.sum("n").alias("n_test"), (F.sum("hit") / F.sum("n")).alias("accuracy"),
                        (F.max("n") / F.sum("n")).alias("majority_rate"), F.lit(num_trees).alias("num_trees"))


def fit_line(df: DataFrame, x: str = "DepDelay", y: str = "ArrDelay", digits: int = 6) -> DataFrame:
    """Least-squares line y = slope * x + intercept (one-feature ML4 form), exact
    and lazy: one aggregation over the rows that have both values."""
    has = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where("NOT isnan(x) AND NOT isnan(y)")
    return has.agg(F.round(F.regr_slope("y", "x"), digits).alias("slope"),
                   F.round(F.regr_intercept("y", "x"), digits).alias("intercept"),
                   F.regr_count("y", "x").alias("n"))


REGRESSION_CATEGORICAL = ["Origin", "Dest", "FlightNum"]
REGRESSION_NUMERIC = ["Distance", "DayOfYear", "DayOfMonth", "DayOfWeek"]


def train_regressor(train: DataFrame, label: str = "ArrDelay", num_features: int = 1 << 10) -> PipelineModel:
    """Delay-minutes regression (ML4): hashed categories + numbers -> ridge
    regression solved from the normal equations: one pass that sums a
    fixed-size (num_features^2) Gram matrix per task, whatever the row count.

    ``num_features`` is the number of hash slots, 4096 at most for this solver;
    categories that share a slot share a weight. Rows without a label can't train;
    a missing feature counts as absent, as in ``predict_delay``.
    ``regressor_report`` tells how many rows and categories that concerns."""
    hasher = FeatureHasher(inputCols=REGRESSION_CATEGORICAL + REGRESSION_NUMERIC,
                           categoricalCols=REGRESSION_CATEGORICAL, outputCol="features",
                           numFeatures=num_features)
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol="Delay",
                          regParam=0.01, elasticNetParam=0.0, solver="normal")
    data = train.select(*REGRESSION_CATEGORICAL, *REGRESSION_NUMERIC, label).where(F.col(label).isNotNull())
    return Pipeline(stages=[hasher, lr]).fit(data)


def regressor_report(train: DataFrame, label: str = "ArrDelay", num_features: int = 1 << 10) -> DataFrame:
    """One row: rows, rows left out for want of a label, rows with a missing
    feature, distinct categories, and hash slots they share."""
    features = REGRESSION_CATEGORICAL + REGRESSION_NUMERIC
    missing = F.greatest(*[F.col(c).isNull().cast("int") for c in features])
    rows = train.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).isNull().cast("long")).alias("n_without_label"),
                     F.sum(missing.cast("long")).alias("n_incomplete"))
    values = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in REGRESSION_CATEGORICAL])).alias("x"))
    categories = values.select("x.c", "x.v").where("v IS NOT NULL").distinct().agg(F.count(F.lit(1)).alias("n_categories"))
    both = rows.unionByName(categories, allowMissingColumns=True)  # two rows, put side by side
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn("slots", F.lit(num_features))


def predict_delay(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predicted delay minutes for requests. The hasher treats a missing value
    as absent (zero), so every request gets a number."""
    out = model.transform(df)
    return out.drop("features")


def features_as_array(df: DataFrame, col: str = "features") -> DataFrame:
    return df.withColumn(col, vector_to_array(F.col(col)))
