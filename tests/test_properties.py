"""Property tests: each draws a whole list of inputs and checks it in one
DataFrame (one Spark job per example), against a plain-Python statement of
the same rule."""

import math
import re

from hypothesis import HealthCheck, given, settings, strategies as st

from aerolake.functions import coerce, labels
from aerolake.operators import relevance

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

numberish = st.one_of(
    st.integers(-10**6, 10**6).map(str),
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(lambda f: f"{f}"),
    st.text(alphabet="0123456789+-. eE", max_size=6),
    st.sampled_from(["", " 7 ", "abc", "1e3", "5.0", "-0", "+3"]),
)


def _py(fn, t):
    try:
        return fn(t)
    except (TypeError, ValueError, OverflowError):
        return None


@SETTINGS
@given(st.lists(numberish, min_size=1, max_size=40))
def test_try_int_matches_python_int(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(coerce.try_int("t")).collect()]
    want = []
    for t in texts:
        v = _py(int, t)
        want.append(v if v is not None and -2**31 <= v < 2**31 else None)
    assert got == want


@SETTINGS
@given(st.lists(st.floats(-200, 200, allow_nan=False), min_size=1, max_size=60))
def test_delay_class_matches_bucket_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "d double")
    got = [r[0] for r in df.select(labels.delay_class("d")).collect()]
    edges = labels.DELAY_SPLITS
    want = [float(next(i for i in range(len(edges) - 1) if edges[i] <= v < edges[i + 1])) for v in values]
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-2, 6).map(float), st.floats(-5, 5, allow_nan=False)),
                min_size=1, max_size=30))
def test_prediction_label_total(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "p double")
    got = [r[0] for r in df.select(labels.prediction_label("p")).collect()]
    for v, g in zip(values, got):
        if v is None:
            assert g == labels.MISSING_TEXT
        elif v in (0.0, 1.0, 2.0, 3.0):
            assert g == labels.CLASS_TEXT[int(v)]
        else:
            assert g.startswith(labels.UNKNOWN_PREFIX)
            shown = g[len(labels.UNKNOWN_PREFIX):]
            assert float(shown) == v


words = st.sampled_from(["red", "plate", "blue", "bolt", "Red", "ring", "the", "of"])


@SETTINGS
@given(st.lists(st.lists(words, min_size=0, max_size=8).map(" ".join), min_size=1, max_size=25),
       st.lists(words, min_size=1, max_size=3).map(" ".join))
def test_bm25_matches_brute_force(spark, docs, query):
    df = spark.createDataFrame(list(enumerate(docs)), "id long, t string")
    got = {r.id: r.score for r in relevance.match_relevance(df, "t", query, id_cols=["id"], digits=None).collect()}
    toks = [[w for w in re.split(r"[ \t\n\r\f]+", d.lower()) if w] for d in docs]
    terms = list(dict.fromkeys(w for w in query.lower().split() if w))
    n, avgdl = len(toks), (sum(map(len, toks)) / len(toks)) or 1.0
    want = {}
    for i, tk in enumerate(toks):
        if not set(tk) & set(terms):
            continue
        s = 0.0
        for q in terms:
            dfq = sum(q in x for x in toks)
            idf = math.log(1 + (n - dfq + 0.5) / (dfq + 0.5))
            tf = tk.count(q)
            s += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(tk) / avgdl))
        want[i] = s
    assert set(got) == set(want)
    for k in want:
        assert math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-12)
