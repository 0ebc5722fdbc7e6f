import math

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from aerolake.operators import joins, ml
from aerolake.operators import requests as rq
from aerolake.plans.context import Tables
from aerolake.session import shared_path
from conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def trained(spark):
    t = Tables(spark, SF_SMALL)
    return t, ml.train_classifier(ml.training_frame(t.flights), num_trees=5)


def test_save_load_identical(spark, trained):
    t, model = trained
    path = ml.save_model(model, shared_path(spark, "test_models", unique=True))
    a = ml.score(model, t.enriched).select("UUID", "prediction")
    b = ml.score(ml.load_model(path), t.enriched).select("UUID", F.col("prediction").alias("p2"))
    j = a.join(b, "UUID")
    assert j.count() == a.count() > 0
    assert j.where("prediction <> p2").count() == 0


def test_index_slots_never_nan(spark, trained):
    t, model = trained
    out = model.transform(rq.with_route(t.enriched))
    for c in ml.INDEX_COLS:
        assert out.where(F.col(c).isNull() | F.isnan(c)).count() == 0


def test_unseen_carrier_scored(spark, trained):
    t, model = trained
    zz = t.enriched.where("Carrier = 'ZZ'")
    assert zz.count() > 0
    assert ml.score(model, zz).where("prediction IS NULL").count() == 0


def test_score_drops_work_columns(spark, trained):
    t, model = trained
    cols = ml.score(model, t.enriched).columns
    assert "prediction" in cols
    assert not set(ml.SCORE_DROP) & set(cols)


def test_accuracy_above_majority(spark):
    t = Tables(spark, SF_MID)
    m = ml.train_metrics(ml.training_frame(t.flights), num_trees=10, seed=1).first()
    assert m.accuracy > m.majority_rate


def test_category_index_matches_string_indexer(spark):
    t = Tables(spark, SF_SMALL)
    fl = rq.with_route(t.flights)
    idx = joins.category_index(fl, ["Carrier", "Route"])
    model = StringIndexer(inputCols=["Carrier", "Route"], outputCols=["a", "b"]).fit(fl)
    for col, labels in zip(["Carrier", "Route"], model.labelsArray):
        got = {r.value: r.idx for r in idx.where(F.col("column") == col).collect()}
        assert got == {v: float(i) for i, v in enumerate(labels)}


def test_fit_line_matches_closed_form(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1.0 + (0.5 if x % 2 else -0.5)) for x in range(20)],
                               "DepDelay double, ArrDelay double")
    got = ml.fit_line(df).first()
    xs = [float(x) for x in range(20)]
    ys = [2.0 * x + 1.0 + (0.5 if int(x) % 2 else -0.5) for x in xs]
    mx, my = sum(xs) / 20, sum(ys) / 20
    slope = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / sum((x - mx) ** 2 for x in xs)
    assert math.isclose(got.slope, round(slope, 6), abs_tol=1e-6)
    assert math.isclose(got.intercept, round(my - slope * mx, 6), abs_tol=1e-6)


def test_regressor_predicts_every_task(spark):
    t = Tables(spark, SF_SMALL)
    model = ml.train_regressor(rq.with_date_parts(t.flights))
    out = ml.predict_delay(model, t.tasks)
    assert out.count() == t.tasks.count()
    assert out.where("Delay IS NULL").count() == 0


def test_category_encoding_is_explicit(spark):
    t = Tables(spark, SF_SMALL)
    train = ml.training_frame(t.flights)
    with pytest.raises(ValueError, match="Route"):
        ml.train_classifier(train, num_trees=3, max_bins=100)
    model = ml.train_classifier(train, num_trees=3, max_bins=100, as_rank=("Route",))
    assert model.stages[-1].getMaxBins() < 100
    out = ml.score(model, t.enriched)
    assert out.where("prediction IS NULL").count() == 0
    assert "Route_index_rank" not in out.columns
    # a limit that nothing reaches changes nothing
    a = ml.score(ml.train_classifier(train, num_trees=3, max_bins=700), t.enriched).select("UUID", "prediction")
    b = ml.score(ml.train_classifier(train, num_trees=3), t.enriched).select("UUID", "prediction")
    assert sorted(a.collect()) == sorted(b.collect())


def test_regressor_keeps_rows_with_missing_features_and_reports(spark):
    rows = [("A", "B", "1", 100.0, 5, 5, 1, 10.0), ("A", None, "2", None, 6, 6, 2, 20.0), ("C", "B", "3", 50.0, 7, 7, 3, None)] * 5
    df = spark.createDataFrame(rows, "Origin string, Dest string, FlightNum string, Distance double, DayOfYear int, DayOfMonth int, DayOfWeek int, ArrDelay double")
    r = ml.regressor_report(df, num_features=64).first()
    assert (r.n, r.n_without_label, r.n_incomplete, r.n_categories, r.slots) == (15, 5, 5, 6, 64)
    out = ml.predict_delay(ml.train_regressor(df, num_features=64), df)
    assert out.count() == 15 and out.where("Delay IS NULL").count() == 0


def test_fit_line_skips_missing_and_is_exact(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1) for x in range(10)] + [(None, 3.0), (4.0, None), (float("nan"), 1.0)], "DepDelay double, ArrDelay double")
    assert tuple(ml.fit_line(df).first()) == (2.0, 1.0, 10)


def test_assembler_skip_and_quarantine(spark):
    t = Tables(spark, SF_SMALL)
    train = ml.training_frame(t.flights)
    reqs = rq.with_route(t.enriched)
    kept = ml.assemble_features(train, reqs)
    skipped = ml.assemble_features(train, reqs, handle_invalid="skip")
    missing = ml.incomplete_rows(reqs).count()
    assert missing > 0  # requests with an unknown route have no distance
    assert kept.count() == reqs.count()
    assert skipped.count() == reqs.count() - missing


def test_hash_split_deterministic_and_complete(spark):
    t = Tables(spark, SF_SMALL)
    fl = t.flights
    a1, b1 = ml.hash_split(fl, "FlightId", 0.2)
    a2, b2 = ml.hash_split(fl, "FlightId", 0.2)
    assert a1.count() + b1.count() == fl.count()
    assert a1.join(b1, "FlightId").count() == 0
    assert sorted(r[0] for r in b1.select("FlightId").collect()) == sorted(r[0] for r in b2.select("FlightId").collect())
    assert 0.15 < b1.count() / fl.count() < 0.25


def test_cached_model_is_published_by_pointer(spark):
    """A half-written model is never met: readers follow the pointer, errors of a build are not hidden."""
    from aerolake.sources import materialize as M

    t = Tables(spark, SF_SMALL)
    inputs = t.paths("lineitem")
    name = f"test_model_{id(t)}"
    fits = []

    def train():
        fits.append(1)
        return ml.train_classifier(ml.training_frame(t.flights), num_trees=2)

    def broken():
        raise RuntimeError("no data")

    with pytest.raises(RuntimeError, match="no data"):
        M.cached_model(spark, name, inputs, broken)
    first = M.cached_model(spark, name, inputs, train)
    path = M._artifact(spark, "models", name, inputs)
    assert M._published(spark, path).startswith(f"{path}/build-")
    M._loaded.clear()
    M._builds.pop(path)  # another application
    again = M.cached_model(spark, name, inputs, train)
    assert fits == [1] and again.uid == first.uid
