"""Plan checks: pushdown, pruning, broadcast of bounded sides, no Python UDF."""

import pytest

import __spark_entry__ as E
from aerolake.operators import joins, rollups
from aerolake.plans.context import Tables
from conftest import SF_SMALL

PLAN_ONLY = ["route_distance", "flight_lookup", "search_flights", "word_count", "match_relevance",
             "request_status", "category_index", "enrich_distance", "coerce_fields", "prediction_label",
             "airplanes_per_carrier", "flights_per_airplane", "make_requests"]


def plan(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", PLAN_ONLY)
def test_no_python_udf(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    for node in ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"]:
        assert node not in p


def test_lookup_pushes_filter_and_prunes(spark):
    t = Tables(spark, SF_SMALL)
    df = t.table("lineitem").where("l_suppkey = 45").select("l_orderkey")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(l_suppkey), EqualTo(l_suppkey,45)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in p


def test_route_distance_reads_only_needed_columns(spark):
    p = plan(E.queries()["route_distance"](spark, SF_SMALL))
    assert "ReadSchema: struct<Origin:string,Dest:string,Distance:double>" in p
    # the unmaterialized view also prunes: lineitem scan reads no prices or flags
    v = plan(rollups.route_distance(Tables(spark, SF_SMALL).flights_view))
    assert "l_extendedprice" not in v and "l_returnflag" not in v


def test_day_lookup_pushes_date_filter(spark):
    p = plan(E.queries()["list_flights"](spark, SF_SMALL))
    assert "PushedFilters" in p and "EqualTo(FlightDate,1995-02-16)" in p


def test_enrich_distance_broadcasts_bounded_routes(spark):
    t = Tables(spark, SF_SMALL)
    base = t.valid.select("event_id", "flight.Origin", "flight.Dest")
    p = plan(joins.enrich_distance(base, t.distances, max_rows=100_000))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_nation_joins_broadcast(spark):
    p = plan(Tables(spark, SF_SMALL).flights_view)
    assert "BroadcastExchange" in p


def test_request_queries_read_the_stored_routes(spark):
    """No flight is read to enrich requests, the stored route table is broadcast after
    its row check even where Spark wouldn't by itself, and a message is parsed once."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("enrich_distance", "request_flatten"):
            p = plan(E.queries()[name](spark, SF_SMALL))
            assert "lineitem" not in p and "tables/flights" not in p
            assert "tables/route_distance" in p and "BroadcastHashJoin" in p and "SortMergeJoin" not in p
        p = plan(E.queries()["enrich_distance"](spark, SF_SMALL))
        assert p.count("from_json(") == p.count("from_json(StructField(Origin") >= 1
        tree = p.split("\n\n\n")[0]
        assert "Generate" in tree
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
